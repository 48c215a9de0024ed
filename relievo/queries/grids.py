"""Queries over cells: masks, resampling, stencils, lakes, geometry."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relievo.functions import datums, geometry
from relievo.operators import filters, grid, joins, lakes, outlines, ranking, validation
from relievo.queries.registry import Tables, q6, query, r6
from relievo.sources import writers

K = ["tile_id", "i", "j"]


@query("f7_valid_land", "SELECT tile_id, i, j, value FROM fx_cells WHERE land > 0 AND value <> 120")
def _(t: Tables) -> DataFrame:
    return filters.valid_land(t.cells, ndv=120.0).select(*K, "value")


@query("f15_type_codes", "SELECT tile_id, i, j, type_id FROM fx_cells WHERE type_id NOT IN (3, 7, 11, 19)")
def _(t: Tables) -> DataFrame:
    return filters.without_codes(t.cells, "type_id", [3, 7, 11, 19]).select(*K, "type_id")


@query(
    "f16_contributors",
    "SELECT tile_id, i, j, contributor FROM fx_cells WHERE contributor <> 0 AND contributor NOT IN (SELECT n_nationkey % 10 FROM nation WHERE contains(n_name, '2'))",
)
def _(t: Tables) -> DataFrame:
    table = t.nation.select((F.col("n_nationkey") % 10).cast("bigint").alias("contributor"), F.col("n_name").alias("institution"))
    return filters.without_contributors(t.cells, table, "2").select(*K, "contributor")


@query("f17_missing_values", "SELECT tile_id, i, j, CASE WHEN size % 3 = 0 THEN -9999e0 ELSE value END AS value FROM fx_cells")
def _(t: Tables) -> DataFrame:
    holes = t.cells.withColumn("value", F.when(F.col("size") % 3 == 0, 0.0).otherwise(F.col("value")))
    return filters.replace_missing(holes, "value", 0.0, -9999.0).select(*K, "value")


@query("f18_trim", "SELECT tile_id, i, j, value FROM fx_cells WHERE size % 3 <> 0")
def _(t: Tables) -> DataFrame:
    return filters.trim_to(t.cells, t.cells.where("size % 3 <> 0")).select(*K, "value")


_BOXES = """x AS (SELECT CAST(n_nationkey AS BIGINT) AS tile_id, CAST(n_nationkey % 7 AS BIGINT) AS i0, CAST(n_nationkey % 7 + 6 AS BIGINT) AS i1,
  CAST(n_nationkey % 5 AS BIGINT) AS j0, CAST(n_nationkey % 5 + 9 AS BIGINT) AS j1 FROM nation)"""


def _boxes(t: Tables) -> DataFrame:
    n = F.col("n_nationkey").cast("bigint")
    return t.nation.select(n.alias("tile_id"), (n % 7).alias("i0"), (n % 7 + 6).alias("i1"), (n % 5).alias("j0"), (n % 5 + 9).alias("j1"))


@query("f14_rectangles", f"WITH {_BOXES} SELECT tile_id, i, j, value FROM fx_cells c WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.tile_id = c.tile_id AND c.i >= i0 AND c.i < i1 AND c.j >= j0 AND c.j < j1)")
def _(t: Tables) -> DataFrame:
    return filters.outside_rectangles(t.cells, _boxes(t)).select(*K, "value")


#: A pentagon in cell units; the SQL casts the same ray.
_RING = [(2.0, 3.0), (16.0, 1.0), (18.0, 11.0), (9.0, 17.0), (4.0, 12.0), (2.0, 3.0)]


def _ring():  # noqa: ANN202
    return F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in _RING))


def _crossings(x: str, y: str) -> str:
    parts = [
        f"(CASE WHEN ({ay} <= {y}) <> ({by} <= {y}) AND {x} < {ax} + ({y} - {ay}) * ({bx - ax}) / ({by - ay}) THEN 1 ELSE 0 END)"
        for (ax, ay), (bx, by) in zip(_RING[:-1], _RING[1:], strict=True)
    ]
    return "(" + " + ".join(parts) + ") % 2 = 1"


_CX, _CY = "CAST(j + 5e-1 AS DOUBLE)", "CAST(i + 5e-1 AS DOUBLE)"


@query("f19_polygon_mask", f"SELECT tile_id, i, j, value FROM fx_cells WHERE NOT ({_crossings(_CX, _CY)})")
def _(t: Tables) -> DataFrame:
    return t.cells.where(~geometry.contains(_ring(), F.col("j") + 0.5, F.col("i") + 0.5)).select(*K, "value")


@query("geo5_point_in_polygon", f"SELECT tile_id, i, j FROM fx_cells WHERE {_crossings(_CX, _CY)}")
def _(t: Tables) -> DataFrame:
    return t.cells.where(geometry.contains(_ring(), F.col("j") + 0.5, F.col("i") + 0.5)).select(*K)


@query("f20_tile_fill", "SELECT tile_id, count(CASE WHEN size % 50 <> 0 THEN value END) AS n_valid FROM fx_cells GROUP BY 1 HAVING count(CASE WHEN size % 50 <> 0 THEN value END) >= 190")
def _(t: Tables) -> DataFrame:
    return filters.tile_fill(t.cells.withColumn("value", F.when(F.col("size") % 50 != 0, F.col("value"))), 190, "full")


@query(
    "f21_region_mask",
    """WITH c AS (SELECT *, CASE tile_id % 3 WHEN 0 THEN 'north' WHEN 1 THEN 'south_bed' ELSE 'south_surface' END AS region, size % 5 AS code, CAST(contributor AS DOUBLE) / 8e0 AS geoid FROM fx_cells)
SELECT tile_id, i, j, value + geoid AS value FROM c WHERE CASE region WHEN 'north' THEN code = 4 WHEN 'south_bed' THEN code < 2 ELSE true END""",
)
def _(t: Tables) -> DataFrame:
    region = F.element_at(F.array(F.lit("north"), F.lit("south_bed"), F.lit("south_surface")), (F.col("tile_id") % 3 + 1).cast("int"))
    rows = t.cells.withColumns({"region": region, "code": F.col("size") % 5, "geoid": F.col("contributor") / 8.0})
    return filters.mask_by_region(rows, "region", "code", "value", "geoid").select(*K, "value")


@query("f22_empty_masks", "SELECT tile_id, i, j FROM fx_cells WHERE tile_id IN (SELECT tile_id FROM fx_cells GROUP BY 1 HAVING max(CASE WHEN tile_id % 4 = 1 THEN 0 ELSE land END) > 0)")
def _(t: Tables) -> DataFrame:
    return filters.without_empty_masks(t.cells.withColumn("land", F.when(F.col("tile_id") % 4 == 1, 0).otherwise(F.col("land")))).select(*K)


@query("g2_cell_centres", "SELECT tile_id, i, j, CAST(tile_id AS DOUBLE) * 10 + (j + 5e-1) * 5e-1 AS x, 50 + (i + 5e-1) * -5e-1 AS y FROM fx_cells")
def _(t: Tables) -> DataFrame:
    return t.cells.select(*K, grid.cell_centre(F.col("j"), F.col("tile_id") * 10.0, F.lit(0.5)).alias("x"), grid.cell_centre(F.col("i"), F.lit(50.0), F.lit(-0.5)).alias("y"))


@query("g7_average", "SELECT tile_id, CAST(floor(i / 4e0) AS BIGINT) AS i, CAST(floor(j / 4e0) AS BIGINT) AS j, " + q6("avg(value)") + " AS value, count(value) AS n FROM fx_cells WHERE size % 3 <> 0 GROUP BY 1, 2, 3")
def _(t: Tables) -> DataFrame:
    return grid.average(t.cells.where("size % 3 <> 0"), 4).withColumn("value", r6("value"))


@query("g8_nearest", "SELECT tile_id, CAST(floor(i / 4e0) AS BIGINT) AS i, CAST(floor(j / 4e0) AS BIGINT) AS j, value FROM fx_cells WHERE i % 4 = 1 AND j % 4 = 1")
def _(t: Tables) -> DataFrame:
    return grid.nearest(t.cells, 4)


_POINTS = "o AS (SELECT o_orderkey AS id, CAST(floor(o_custkey / 4e2) AS BIGINT) AS tile_id, CAST(o_custkey % 160 AS DOUBLE) / 8e0 AS y, CAST(o_orderkey % 160 AS DOUBLE) / 8e0 AS x FROM orders)"


def _points(t: Tables) -> DataFrame:
    c = F.col("o_custkey")
    return t.orders.select(F.col("o_orderkey").alias("id"), F.floor(c / 400.0).alias("tile_id"), ((c % 160) / 8.0).alias("y"), ((F.col("o_orderkey") % 160) / 8.0).alias("x"))


@query(
    "g9_bilinear",
    f"""WITH {_POINTS}, s AS (SELECT id, tile_id, y - 5e-1 AS fy, x - 5e-1 AS fx, CAST(floor(y - 5e-1) AS BIGINT) + di AS i, CAST(floor(x - 5e-1) AS BIGINT) + dj AS j FROM o, (VALUES (0), (1)) a(di), (VALUES (0), (1)) b(dj)),
w AS (SELECT id, tile_id, i, j, (1 - abs(fy - i)) * (1 - abs(fx - j)) AS w FROM s)
SELECT id, {q6('sum(w * value) / sum(w)')} AS value FROM w JOIN fx_cells USING (tile_id, i, j) WHERE w <> 0 GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return grid.interpolate(t.cells, _points(t)).select("id", r6("value").alias("value"))


_KERNEL = "CASE WHEN abs({0}) <= 1 THEN (15e-1 * abs({0}) - 25e-1) * abs({0}) * abs({0}) + 1e0 WHEN abs({0}) < 2 THEN ((-5e-1 * abs({0}) + 25e-1) * abs({0}) - 4e0) * abs({0}) + 2e0 ELSE 0e0 END"


@query(
    "g10_cubic",
    f"""WITH {_POINTS}, s AS (SELECT id, tile_id, y - 5e-1 AS fy, x - 5e-1 AS fx, CAST(floor(y - 5e-1) AS BIGINT) + di AS i, CAST(floor(x - 5e-1) AS BIGINT) + dj AS j
  FROM o, (VALUES (-1), (0), (1), (2)) a(di), (VALUES (-1), (0), (1), (2)) b(dj)),
w AS (SELECT id, tile_id, i, j, ({_KERNEL.format('(fy - i)')}) * ({_KERNEL.format('(fx - j)')}) AS w FROM s)
SELECT id, {q6('sum(w * value) / nullif(sum(w), 0)')} AS value FROM w JOIN fx_cells USING (tile_id, i, j) WHERE w <> 0 GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return grid.interpolate(t.cells, _points(t), "cubic").select("id", r6("value").alias("value"))


@query(
    "g11_no_coastal_creep",
    f"""WITH c AS (SELECT * FROM fx_cells WHERE size % 3 <> 0), a AS (SELECT tile_id, CAST(floor(i / 4e0) AS BIGINT) AS i, CAST(floor(j / 4e0) AS BIGINT) AS j, {q6('avg(value)')} AS value, count(value) AS n FROM c GROUP BY 1, 2, 3),
n AS (SELECT tile_id, CAST(floor(i / 4e0) AS BIGINT) AS i, CAST(floor(j / 4e0) AS BIGINT) AS j FROM c WHERE i % 4 = 1 AND j % 4 = 1) SELECT a.* FROM a JOIN n USING (tile_id, i, j)""",
)
def _(t: Tables) -> DataFrame:
    return grid.average_without_creep(t.cells.where("size % 3 <> 0"), 4).withColumn("value", r6("value"))


@query(
    "g12_snapped_extent",
    "SELECT tile_id, CAST(floor(min(i) / 4e0) * 4 AS BIGINT) AS i0, CAST(ceil((max(i) + 1) / 4e0) * 4 AS BIGINT) AS i1, CAST(floor(min(j) / 4e0) * 4 AS BIGINT) AS j0, CAST(ceil((max(j) + 1) / 4e0) * 4 AS BIGINT) AS j1 FROM fx_cells WHERE i + j > 9 GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    return grid.snapped_extent(t.cells.where("i + j > 9"), 4).select("tile_id", *(F.col(c).cast("bigint").alias(c) for c in ("i0", "i1", "j0", "j1")))


@query(
    "g13_mosaic",
    "SELECT i + tile_id % 3 * 15 AS i, j + CAST(floor(tile_id / 3e0) AS BIGINT) * 15 AS j, arg_max(value, tile_id) AS value FROM fx_cells GROUP BY 1, 2",
)
def _(t: Tables) -> DataFrame:
    k = F.col("tile_id")
    offsets = t.cells.select("tile_id").distinct().select(k, (k % 3 * 15).alias("di"), (F.floor(k / 3.0) * 15).alias("dj"), k.alias("listed"))
    return grid.mosaic(t.cells, offsets)


_HORN = ", ".join(f"({di}, {dj}, {wx}, {wy})" for di, dj, wx, wy in grid.HORN)


@query(
    "g14_slope",
    f"""WITH h(di, dj, wx, wy) AS (VALUES {_HORN}),
g AS (SELECT c.tile_id, c.i, c.j, sum(wx * coalesce(n.value, c.value)) / (8 * 5e-1 * 111120e0) AS gx, sum(wy * coalesce(n.value, c.value)) / (8 * 5e-1 * 111120e0) AS gy
  FROM (SELECT * FROM fx_cells, h) c LEFT JOIN fx_cells n ON n.tile_id = c.tile_id AND n.i = c.i + di AND n.j = c.j + dj GROUP BY 1, 2, 3)
SELECT tile_id, i, j, {q6('degrees(atan(sqrt(gx * gx + gy * gy)))')} AS slope FROM g""",
)
def _(t: Tables) -> DataFrame:
    return grid.slope(t.cells, 0.5, -0.5, edges=True).withColumn("slope", r6("slope"))


@query(
    "g15_isolated_cells",
    # the distinct cells within two steps, counted outright
    """WITH c AS (SELECT tile_id, i, j FROM fx_cells WHERE size % 3 = 0),
s AS (SELECT a.tile_id, a.i, a.j, b.i AS i2, b.j AS j2 FROM c a JOIN c b ON a.tile_id = b.tile_id AND abs(a.i - b.i) + abs(a.j - b.j) <= 1),
r AS (SELECT DISTINCT s.tile_id, s.i, s.j, t.i2, t.j2 FROM s JOIN s t ON t.tile_id = s.tile_id AND t.i = s.i2 AND t.j = s.j2)
SELECT tile_id, i, j FROM r GROUP BY 1, 2, 3 HAVING count(*) <= 3""",
)
def _(t: Tables) -> DataFrame:
    return grid.isolated(t.cells.where("size % 3 = 0"))


_LAKES = """c AS (SELECT * FROM fx_cells WHERE size % 3 <> 0),
e AS (SELECT a.tile_id, a.i * 1048576 + a.j AS x, b.i * 1048576 + b.j AS y FROM c a JOIN c b ON a.tile_id = b.tile_id AND abs(a.i - b.i) + abs(a.j - b.j) <= 1),
r(tile_id, x, y) AS (SELECT tile_id, x, y FROM e UNION SELECT r.tile_id, r.x, e.y FROM r JOIN e ON e.tile_id = r.tile_id AND e.x = r.y),
m AS (SELECT tile_id, x, min(y) AS lake FROM r GROUP BY 1, 2),
k AS (SELECT c.*, m.lake FROM c JOIN m ON m.tile_id = c.tile_id AND m.x = c.i * 1048576 + c.j)"""


def lake_cells(t: Tables) -> DataFrame:
    return lakes.label(t.cells.where("size % 3 <> 0"))


@query("g16_lake_labels", f"WITH RECURSIVE {_LAKES} SELECT tile_id, i, j, lake FROM k")
def _(t: Tables) -> DataFrame:
    return lake_cells(t).select(*K, "lake")


_STATS = f"""{_LAKES},
v AS (SELECT tile_id, lake, floor(value / 1e1) AS e, count(*) AS m, row_number() OVER (PARTITION BY tile_id, lake ORDER BY count(*) DESC, floor(value / 1e1)) AS o FROM k GROUP BY 1, 2, 3),
s AS (SELECT tile_id, lake, count(*) AS n, min(i) AS i0, max(i) AS i1, min(j) AS j0, max(j) AS j1, avg(floor(value / 1e1)) AS mean, avg(CAST(size AS DOUBLE)) AS dmean, stddev_pop(CAST(size AS DOUBLE)) AS dstd, min(size) AS dmin, max(size) AS dmax FROM k GROUP BY 1, 2),
z AS (SELECT s.*, CASE WHEN n < 5 THEN mean ELSE e END AS surface, CASE WHEN n < 5 THEN 1e0 ELSE m / CAST(n AS DOUBLE) END AS surface_share FROM s JOIN v USING (tile_id, lake) WHERE o = 1)"""


@query(
    "a16_lake_statistics",
    f"WITH RECURSIVE {_STATS} SELECT tile_id, lake, n, i0, i1, j0, j1, {q6('surface')} AS surface, {q6('surface_share')} AS surface_share, {q6('dmean')} AS depth_mean, {q6('dstd')} AS depth_std, dmin AS depth_min, dmax AS depth_max FROM z",
)
def _(t: Tables) -> DataFrame:
    rows = lake_cells(t).withColumns({"value": F.floor(F.col("value") / 10.0).cast("double"), "depth": F.col("size")})
    out = validation.lake_statistics(rows, ["depth"])
    return out.select("tile_id", "lake", "n", "i0", "i1", "j0", "j1", *(r6(c).alias(c) for c in ("surface", "surface_share", "depth_mean", "depth_std")), "depth_min", "depth_max")


@query(
    "g17_lake_beds",
    f"""WITH RECURSIVE {_STATS},
b AS (SELECT k.tile_id, k.i, k.j, k.lake, z.surface, floor(k.value / 1e1) - k.size % 4 AS bed_a, floor(k.value / 1e1) - k.size % 7 AS bed_b FROM k JOIN z USING (tile_id, lake)),
p AS (SELECT tile_id, lake, avg(CASE WHEN bed_b < surface THEN 1e0 ELSE 0e0 END) AS share FROM b GROUP BY 1, 2),
d AS (SELECT b.*, CASE WHEN share >= 8e-1 THEN bed_b ELSE bed_a END AS bed FROM b JOIN p USING (tile_id, lake)),
x AS (SELECT tile_id, lake, max(bed) AS nxt FROM d WHERE bed < surface GROUP BY 1, 2)
SELECT d.tile_id, i, j, d.lake, {q6('CASE WHEN bed < surface THEN bed ELSE coalesce(nxt, surface - 1) END')} AS bed FROM d LEFT JOIN x USING (tile_id, lake)""",
)
def _(t: Tables) -> DataFrame:
    rows = lake_cells(t).withColumn("value", F.floor(F.col("value") / 10.0).cast("double"))
    rows = rows.withColumns({"bed_a": F.col("value") - F.col("size") % 4, "bed_b": F.col("value") - F.col("size") % 7})
    return lakes.choose_beds(rows).select(*K, "lake", r6("bed").alias("bed"))


@query(
    "j14_lake_exceptions",
    f"""WITH RECURSIVE {_LAKES}, ru AS (SELECT p_partkey AS place, p_partkey % 6 AS tile_id, CASE WHEN p_partkey % 40 = 39 THEN -1 ELSE p_partkey % 19 END AS row, CASE WHEN p_partkey % 40 = 39 THEN -1 ELSE p_partkey % 13 END AS col, p_size % 2 = 0 AS decision, p_partkey % 50 = 31 AS all_other FROM part),
f AS (SELECT k.tile_id, k.lake, place, CASE WHEN row = -1 OR (ru.row = k.i AND ru.col = k.j) THEN decision ELSE false END AS decision, CASE WHEN ru.row = k.i AND ru.col = k.j THEN 0 ELSE 1 END AS rank
  FROM k JOIN ru ON ru.tile_id = k.tile_id AND ((row = -1 AND col = -1) OR (ru.row = k.i AND ru.col = k.j) OR all_other)),
o AS (SELECT *, row_number() OVER (PARTITION BY tile_id, lake ORDER BY place, rank) AS n FROM f)
SELECT DISTINCT k.tile_id, k.lake, o.decision FROM k LEFT JOIN o ON o.tile_id = k.tile_id AND o.lake = k.lake AND o.n = 1""",
)
def _(t: Tables) -> DataFrame:
    n = F.col("p_partkey")
    at = lambda v: F.when(n % 40 == 39, -1).otherwise(v)
    rules = t.part.select(
        n.alias("place"), (n % 6).alias("tile_id"), at(n % 19).alias("row"), at(n % 13).alias("col"), (F.col("p_size") % 2 == 0).alias("decision"), (n % 50 == 31).alias("all_other")
    )
    return joins.exceptions(lake_cells(t), rules)


@query(
    "mask3_lake_depths",
    f"WITH RECURSIVE {_STATS} SELECT k.tile_id, k.i, k.j, k.lake, {q6('z.surface - k.size')} AS bed FROM k JOIN z USING (tile_id, lake) WHERE z.n >= 5",
)
def _(t: Tables) -> DataFrame:
    rows = lake_cells(t).withColumn("value", F.floor(F.col("value") / 10.0).cast("double"))
    stats = validation.lake_statistics(rows, []).select(F.struct("tile_id", "lake").alias("lake"), F.col("n").alias("area"), "surface")
    cells = rows.select(*K, F.struct("tile_id", "lake").alias("lake"), F.col("size").alias("depth"))
    return lakes.depths(stats, cells, 5).select(*K, "lake.lake", r6("bed").alias("bed"))


@query(
    "g18_fill_holes",
    f"""WITH h AS (SELECT tile_id, i, j FROM fx_cells WHERE size % 3 = 0), c AS (SELECT * FROM fx_cells WHERE size % 3 <> 0)
SELECT h.tile_id, h.i, h.j, {q6('sum(c.value / sqrt((c.i - h.i) * (c.i - h.i) + (c.j - h.j) * (c.j - h.j))) / sum(1 / sqrt((c.i - h.i) * (c.i - h.i) + (c.j - h.j) * (c.j - h.j)))')} AS value
FROM h JOIN c ON c.tile_id = h.tile_id AND (c.i - h.i) * (c.i - h.i) + (c.j - h.j) * (c.j - h.j) <= 4 GROUP BY 1, 2, 3""",
)
def _(t: Tables) -> DataFrame:
    return grid.fill(t.cells.where("size % 3 <> 0"), t.cells.where("size % 3 = 0"), 2).withColumn("value", r6("value"))


@query("g19_datum_shift", "SELECT c.tile_id, c.i, c.j, value + CAST(contributor AS DOUBLE) / 8e0 AS value FROM fx_cells c")
def _(t: Tables) -> DataFrame:
    return grid.shifted(t.cells.select(*K, "value"), t.cells.select(*K, (F.col("contributor") / 8.0).alias("offset")))


@query("g21_wrapped_longitude", "SELECT c_custkey AS id, CASE WHEN x < -180 THEN x + 360 WHEN x > 180 THEN x - 360 ELSE x END AS x FROM (SELECT c_custkey, CAST(c_custkey % 721 AS DOUBLE) - 360e0 AS x FROM customer) s")
def _(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("id"), grid.wrapped((F.col("c_custkey") % 721).cast("double") - 360.0).alias("x"))


@query(
    "mask1_land_mask",
    "SELECT tile_id, i, j FROM fx_cells WHERE (land > 0 OR size = 25) AND size % 9 <> 0 AND size % 11 <> 0 AND contributor <> 7",
)
def _(t: Tables) -> DataFrame:
    c = t.cells
    return grid.land_mask(c.where("land > 0"), c.where("size % 9 = 0"), c.where("size % 11 = 0"), c.where("contributor = 7"), c.where("size = 25"))


@query("mask2_has_land", "SELECT tile_id, max(land) > 0 AS has_land FROM fx_cells GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return grid.has_land(t.cells)




@query(
    "a13_hypsometry",
    # land and sea from -860 m on, also under the least that counts as land
    f"""WITH h AS (SELECT 'm' AS unit, CAST(unnest(range(-11000, 9000, 100)) AS DOUBLE) AS threshold UNION ALL SELECT 'ft', CAST(unnest(range(-36000, 29250, 200)) AS DOUBLE)),
t AS (SELECT *, CASE WHEN unit = 'ft' THEN threshold / 32808399e-7 ELSE threshold END AS metres FROM h),
e AS (SELECT size * 4e1 - 9e2 AS v, land > 0 AND size * 4e1 - 9e2 >= -420 AS l FROM fx_cells), n AS (SELECT count(*) AS total, count(*) FILTER (WHERE l) AS total_land FROM e)
SELECT unit, threshold, count(v) AS all_above, count(v) FILTER (WHERE l) AS land_above, {q6('1e2 * count(v) / any_value(total)')} AS pct_all, {q6('1e2 * count(v) FILTER (WHERE l) / any_value(total_land)')} AS pct_land
FROM n, t LEFT JOIN e ON v >= metres GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    out = validation.hypsometry_table(t.cells.withColumn("value", F.col("size") * 40.0 - 900.0), F.col("land") > 0)
    return out.select("unit", F.col("threshold").cast("double").alias("threshold"), "all_above", "land_above", r6("pct_all").alias("pct_all"), r6("pct_land").alias("pct_land"))


@query(
    "a14_merged_hypsometry",
    f"""WITH h AS (SELECT CAST(unnest(range(0, 300, 10)) AS DOUBLE) AS threshold), p AS (SELECT threshold, tile_id, count(*) FILTER (WHERE value >= threshold) AS n_above, count(*) AS n_total FROM fx_cells, h GROUP BY 1, 2)
SELECT threshold, CAST(sum(n_above) AS BIGINT) AS n_above, CAST(sum(n_total) AS BIGINT) AS n_total, {q6('1e2 * sum(n_above) / sum(n_total)')} AS pct_above FROM p GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    levels = F.explode(F.expr("transform(sequence(0, 29), k -> cast(k * 10 as double))"))
    parts = t.cells.select("tile_id", "value", levels.alias("threshold")).groupBy("threshold", "tile_id").agg(F.count_if(F.col("value") >= F.col("threshold")).alias("n_above"), F.count("*").alias("n_total"))
    return validation.merge_hypsometries(parts).withColumn("pct_above", r6("pct_above"))


@query(
    "a15_weighted_hypsometry",
    f"""WITH h AS (SELECT CAST(unnest(range(0, 300)) AS DOUBLE) AS threshold), c AS (SELECT value, cos(radians(CAST(tile_id % 5 * 15 AS DOUBLE) + 75e-1)) AS w FROM fx_cells), n AS (SELECT sum(w) AS total FROM c)
SELECT threshold, {q6('1e2 * coalesce(sum(w), 0) / any_value(total)')} AS pct_all FROM n, h LEFT JOIN c ON value >= threshold GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    weight = validation.tile_weight((F.col("tile_id") % 5 * 15).cast("double"))
    out = validation.hypsometry(t.cells, 0.0, 1.0, 300, weight)
    return out.select(F.col("threshold").cast("double").alias("threshold"), r6("pct_all").alias("pct_all"))


@query("a17_valid_share", f"SELECT tile_id, count(*) AS n, {q6('1e2 * count(CASE WHEN size % 3 <> 0 THEN value END) / count(*)')} AS pct_valid, {q6('1e2 * count(*) FILTER (WHERE land = 0) / count(*)')} AS pct_masked FROM fx_cells GROUP BY 1")
def _(t: Tables) -> DataFrame:
    out = validation.valid_share(t.cells.withColumn("value", F.when(F.col("size") % 3 != 0, F.col("value"))))
    return out.select("tile_id", "n", r6("pct_valid").alias("pct_valid"), r6("pct_masked").alias("pct_masked"))


@query(
    "a18_raster_difference",
    f"SELECT tile_id, count(*) AS n, min(CAST(contributor AS DOUBLE) / 8e0) AS min, max(CAST(contributor AS DOUBLE) / 8e0) AS max, {q6('avg(CAST(contributor AS DOUBLE) / 8e0)')} AS mean, {q6('stddev_pop(CAST(contributor AS DOUBLE) / 8e0)')} AS std FROM fx_cells GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    moved = t.cells.withColumn("value", F.col("value") + F.col("contributor") / 8.0)
    out = validation.difference(moved.select(*K, "value"), t.cells.select(*K, "value"))
    return out.select("tile_id", "n", "min", "max", r6("mean").alias("mean"), r6("std").alias("std"))


@query("j11_slope_lookup", "SELECT tile_id, i, j, value, CAST(size AS DOUBLE) / 4e0 AS slope FROM fx_cells")
def _(t: Tables) -> DataFrame:
    return joins.lookup(t.cells.select(*K, "value"), t.cells.select(*K, (F.col("size") / 4.0).alias("slope")), K, "slope")


@query("snk3_dense_grid", "SELECT g.tile_id, a.i, b.j, coalesce(c.value, -99999e0) AS value FROM (SELECT DISTINCT tile_id FROM fx_cells) g, (SELECT unnest(range(0, 20)) AS i) a, (SELECT unnest(range(0, 20)) AS j) b LEFT JOIN (SELECT * FROM fx_cells WHERE size % 3 <> 0) c ON c.tile_id = g.tile_id AND c.i = a.i AND c.j = b.j")
def _(t: Tables) -> DataFrame:
    grids = t.cells.select("tile_id").distinct().withColumns({"xsize": F.lit(20), "ysize": F.lit(20)})
    return writers.dense(t.cells.where("size % 3 <> 0"), grids).select(*K, "value")


@query("snk7_value_ranges", f"SELECT CAST(contributor AS STRING) AS filename, min(value) AS min, max(value) AS max, {q6('avg(value)')} AS mean, {q6('stddev_pop(value)')} AS std FROM fx_cells GROUP BY 1")
def _(t: Tables) -> DataFrame:
    out = writers.value_ranges(t.cells.withColumn("filename", F.col("contributor").cast("string")))
    return out.select("filename", "min", "max", r6("mean").alias("mean"), r6("std").alias("std"))


@query("w2_supersede", "SELECT i, j, arg_max(elev, (weight, filename, elev)) AS elev, max(weight) AS weight, arg_max(filename, (weight, filename, elev)) AS filename FROM fx_source_cells GROUP BY 1, 2")
def _(t: Tables) -> DataFrame:
    return ranking.supersede(t.source_cells)


@query("w4_source_ids", "SELECT source_id, count(*) AS n FROM (SELECT CAST(floor(max(weight + CAST(CAST(filename AS BIGINT) AS DOUBLE) / 1e2)) AS BIGINT) AS source_id FROM fx_source_cells GROUP BY i, j) s GROUP BY 1")
def _(t: Tables) -> DataFrame:
    w = F.col("weight") + F.col("filename").cast("double") / 100.0
    won = ranking.supersede(t.source_cells.withColumn("weight", w))
    return won.groupBy(ranking.source_id(F.col("weight")).alias("source_id")).agg(F.count("*").alias("n"))


@query("geo3_dateline", "SELECT s_suppkey AS id, (x0 <= -180 + 1e-6 OR x1 <= -180 + 1e-6) AND (x0 >= 180 - 1e-6 OR x1 >= 180 - 1e-6) AS crosses FROM (SELECT s_suppkey, CAST(-180 + s_suppkey % 3 AS DOUBLE) AS x0, CAST(180 - s_suppkey % 2 AS DOUBLE) AS x1 FROM supplier) s")
def _(t: Tables) -> DataFrame:
    s = F.col("s_suppkey")
    ring = geometry.box_ring(-180 + s % 3, F.lit(0), 180 - s % 2, F.lit(1))
    return t.supplier.select(s.alias("id"), geometry.crosses_dateline(ring).alias("crosses"))


@query("geo4_ring_area", "SELECT s_suppkey AS id, CAST((1 + s_suppkey % 9) * (1 + s_suppkey % 7) AS DOUBLE) AS area FROM supplier")
def _(t: Tables) -> DataFrame:
    s = F.col("s_suppkey")
    ring = geometry.box_ring(s % 70, s % 50, s % 70 + 1 + s % 9, s % 50 + 1 + s % 7)
    return t.supplier.select(s.alias("id"), geometry.signed_area(geometry.anticlockwise(F.reverse(ring))).alias("area"))


@query("geo2_densified_ring", "SELECT s_suppkey AS id, CAST(4 * 8 + 1 AS BIGINT) AS n_points, CAST((1 + s_suppkey % 9) * (1 + s_suppkey % 7) AS DOUBLE) AS area FROM supplier")
def _(t: Tables) -> DataFrame:
    s = F.col("s_suppkey")
    ring = geometry.densified(geometry.box_ring(s % 64, s % 32, s % 64 + 1 + s % 9, s % 32 + 1 + s % 7), 8)
    return t.supplier.select(s.alias("id"), F.size(ring).cast("bigint").alias("n_points"), r6(geometry.signed_area(ring)).alias("area"))


@query("geo6_poles", "SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN 'N' WHEN s_suppkey % 3 = 1 THEN 'S' END AS pole FROM supplier")
def _(t: Tables) -> DataFrame:
    s = F.col("s_suppkey")
    point = lambda x, y: F.struct(F.lit(float(x)).alias("x"), y.cast("double").alias("y"))
    lat = F.when(s % 3 == 0, 60 + s % 20).otherwise(-(60 + s % 20))
    around = F.array(*(point(x, lat) for x in (-180, -90, 0, 90, 180)), point(-180, lat))
    box = F.array(point(0, lat), point(10, lat), point(10, lat + 1), point(0, lat + 1), point(0, lat))
    return t.supplier.select(s.alias("id"), geometry.pole(F.when(s % 3 < 2, around).otherwise(box)).alias("pole"))




#: The series of the transverse Mercator projection in the third flattening of WGS 84.
_THIRD = (1 / 298.257223563) / (2 - 1 / 298.257223563)
_SERIES = [f"{a:.17e}" for a in (_THIRD / 2 - 2 * _THIRD**2 / 3 + 5 * _THIRD**3 / 16, 13 * _THIRD**2 / 48 - 3 * _THIRD**3 / 5, 61 * _THIRD**3 / 240)]
_SCALE = f"9996e-4 * {6378137 / (1 + _THIRD) * (1 + _THIRD**2 / 4 + _THIRD**4 / 64):.17e}"
_ROOT = f"{2 * _THIRD**0.5 / (1 + _THIRD):.17e}"
_MILLIMETRES = "floor(({}) * 1e3 + 5e-1) / 1e3"


@query(
    "geo1_utm",
    f"""WITH p AS (SELECT c_custkey AS id, radians(1e0 + (c_custkey % 800) / 1e1) AS phi, radians(12e0 + (c_custkey % 600) / 1e2 - 15e0) AS lam FROM customer),
q AS (SELECT id, lam, sinh(atanh(sin(phi)) - {_ROOT} * atanh({_ROOT} * sin(phi))) AS t FROM p),
r AS (SELECT id, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM q)
SELECT id, {_MILLIMETRES.format(f"500000 + {_SCALE} * (eta + " + " + ".join(f"{a} * cos({2 * k} * xi) * sinh({2 * k} * eta)" for k, a in enumerate(_SERIES, 1)) + ")")} AS x,
  {_MILLIMETRES.format(f"{_SCALE} * (xi + " + " + ".join(f"{a} * sin({2 * k} * xi) * cosh({2 * k} * eta)" for k, a in enumerate(_SERIES, 1)) + ")")} AS y FROM r""",
)
def _(t: Tables) -> DataFrame:
    c = F.col("c_custkey")
    xy = geometry.project(12.0 + (c % 600) / 100.0, 1.0 + (c % 800) / 10.0, 32633)
    return t.customer.select(c.alias("id"), *((F.floor(xy[k] * 1e3 + 0.5) / 1e3).alias(k) for k in ("x", "y")))


@query(
    "geo1_resampled",
    f"""WITH ra AS (SELECT DISTINCT tile_id, tile_id % 60 + 1 AS zone, 400000 + tile_id % 7 * 1000 AS xleft, 5000000 + tile_id % 9 * 40000 AS ytop FROM fx_cells),
tg AS (SELECT ra.*, i, j, 90 - (i + 5e-1) * 125e-3 AS lat, -180 + (j + 5e-1) * 125e-3 AS lon
  FROM (SELECT *, unnest(range(CAST(floor((90 - ytop / 109e3) * 8) AS BIGINT), CAST(floor((90 - (ytop - 100000) / 113e3) * 8) AS BIGINT))) AS i FROM ra) ra,
  (SELECT unnest(range(0, 2880)) AS j) b WHERE abs(-180 + (j + 5e-1) * 125e-3 - (zone * 6 - 183)) < 3),
q AS (SELECT *, radians(lon - (zone * 6 - 183)) AS lam, sinh(atanh(sin(radians(lat))) - {_ROOT} * atanh({_ROOT} * sin(radians(lat)))) AS t FROM tg),
u AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM q),
m AS (SELECT *, 500000 + {_SCALE} * (eta + {" + ".join(f"{a} * cos({2 * k} * xi) * sinh({2 * k} * eta)" for k, a in enumerate(_SERIES, 1))}) AS px,
  {_SCALE} * (xi + {" + ".join(f"{a} * sin({2 * k} * xi) * cosh({2 * k} * eta)" for k, a in enumerate(_SERIES, 1))}) AS py FROM u),
n AS (SELECT tile_id, i, j, (px - xleft) / 5e3 - 5e-1 AS fx, (ytop - py) / 5e3 - 5e-1 AS fy FROM m),
w AS (SELECT n.tile_id, n.i, n.j, c.value, (1 - abs(fy - c.i)) * (1 - abs(fx - c.j)) AS w FROM n JOIN fx_cells c
  ON c.tile_id = n.tile_id AND c.i BETWEEN floor(fy) AND floor(fy) + 1 AND c.j BETWEEN floor(fx) AND floor(fx) + 1 WHERE fx >= -5e-1 AND fx < 195e-1 AND fy >= -5e-1 AND fy < 195e-1)
SELECT tile_id, i, j, {q6('sum(w * value) / sum(w)')} AS value FROM w WHERE w <> 0 GROUP BY 1, 2, 3""",
)
def _(t: Tables) -> DataFrame:
    tile = F.col("tile_id")
    rasters = t.cells.select("tile_id").distinct().select(
        "tile_id", (32601 + tile % 60).alias("epsg"), (400000.0 + tile % 7 * 1000).alias("xleft"), (5000000.0 + tile % 9 * 40000).alias("ytop"),
        F.lit(5000.0).alias("xres"), F.lit(-5000.0).alias("yres"), F.lit(20).alias("xsize"), F.lit(20).alias("ysize"),
    )
    return grid.resampled(t.cells, rasters, 0.125).select(*K, r6("value").alias("value"))


_LATITUDE_TERMS = [f"{d:.17e}" for d in (
    2 * _THIRD - 2 * _THIRD**2 / 3 - 2 * _THIRD**3 + 116 * _THIRD**4 / 45, 7 * _THIRD**2 / 3 - 8 * _THIRD**3 / 5 - 227 * _THIRD**4 / 45, 56 * _THIRD**3 / 15 - 136 * _THIRD**4 / 35, 4279 * _THIRD**4 / 630,
)]
#: Metres of the polar grid at its pole: the true scale is at 70 degrees.
_E1 = (2 / 298.257223563 - 1 / 298.257223563**2) ** 0.5
_S70 = math.sin(math.radians(70))
_POLE = f"{6378137 * math.cos(math.radians(70)) / (1 - _E1**2 * _S70**2) ** 0.5 * ((1 - _E1 * _S70) / (1 + _E1 * _S70)) ** (_E1 / 2) / math.tan(math.radians(10)):.17e}"


@query(
    "geo1_polar_inverse",
    f"""WITH p AS (SELECT c_custkey AS id, CAST(c_custkey % 401 - 200 AS DOUBLE) * 15000 AS x, CAST(c_custkey % 397 - 198 AS DOUBLE) * 15000 AS y FROM customer),
c AS (SELECT id, x, y, pi() / 2 - 2 * atan(sqrt(x * x + y * y) / {_POLE}) AS chi FROM p WHERE x <> 0 OR y <> 0),
g AS (SELECT id, degrees(atan2(x, -y)) - 45 AS lon, degrees(chi + {" + ".join(f"{d} * sin({2 * k} * chi)" for k, d in enumerate(_LATITUDE_TERMS, 1))}) AS lat FROM c)
SELECT id, {q6('CASE WHEN lon < -180 THEN lon + 360 ELSE lon END')} AS lon, {q6('lat')} AS lat FROM g""",
)
def _(t: Tables) -> DataFrame:
    c = F.col("c_custkey")
    rows = t.customer.select(c.alias("id"), (c % 401 - 200).cast("double").alias("x"), (c % 397 - 198).cast("double").alias("y")).where("x <> 0 or y <> 0")
    back = geometry.unproject(F.col("x") * 15000, F.col("y") * 15000, 3413)
    return rows.select("id", r6(back["x"]).alias("lon"), r6(back["y"]).alias("lat"))


@query(
    "geo8_outline_rings",
    # every border edge of a unit cell is followed to the next one until it comes back
    """WITH RECURSIVE c AS (SELECT DISTINCT x, unnest(range(ymin, ymax)) AS y FROM (SELECT *, unnest(range(xmin, xmax)) AS x FROM fx_sources) s),
s(dx0, dy0, dx1, dy1, nx, ny, dir) AS (VALUES (0, 0, 1, 0, 0, -1, 0), (1, 0, 1, 1, 1, 0, 1), (1, 1, 0, 1, 0, 1, 2), (0, 1, 0, 0, -1, 0, 3)),
e AS (SELECT x + dx0 AS x0, y + dy0 AS y0, x + dx1 AS x1, y + dy1 AS y1, dir, (x + dx0) * 4000 + (y + dy0) * 4 + dir AS id FROM c, s
  WHERE NOT EXISTS (SELECT 1 FROM c o WHERE o.x = c.x + nx AND o.y = c.y + ny)),
n AS (SELECT a.id, a.dir, arg_max(b.id, (b.dir - a.dir + 6) % 4) AS nxt FROM e a JOIN e b ON b.x0 = a.x1 AND b.y0 = a.y1 GROUP BY 1, 2),
r(id, reach) AS (SELECT id, nxt FROM n UNION SELECT r.id, n.nxt FROM r JOIN n ON n.id = r.reach),
l AS (SELECT id, min(reach) AS ring FROM r GROUP BY 1)
SELECT CAST(l.ring // 4000 AS DOUBLE) AS x, CAST(l.ring % 4000 // 4 AS DOUBLE) AS y, count(*) FILTER (WHERE e.dir <> f.dir) AS n_points,
  sum(e.x0 * e.y1 - e.x1 * e.y0) / 2e0 AS area, sum(e.x0 * e.y1 - e.x1 * e.y0) < 0 AS is_hole
FROM l JOIN e ON e.id = l.id JOIN n ON n.id = e.id JOIN e f ON f.id = n.nxt GROUP BY l.ring""",
)
def _(t: Tables) -> DataFrame:
    return outlines.outline_rings(t.sources).drop("ring")


#: A four-sided polygon around each source file, as its corners (x, y).
_KITE = ("xmin + 25e-2, ymin", "xmax + 5e-1, ymin + 75e-2", "xmax, ymax + 15e-1", "xmin - 1e0, ymax")


@query(
    "f19_scan_lines",
    f"""WITH v AS (SELECT source_key, [{", ".join(f"[{p}]" for p in (*_KITE, _KITE[0]))}] AS p FROM fx_sources),
e AS (SELECT source_key, p[k][1] AS ax, p[k][2] AS ay, p[k + 1][1] AS zx, p[k + 1][2] AS zy FROM (SELECT *, unnest(range(1, 5)) AS k FROM v) q),
c AS (SELECT tile_id, i, j, tile_id % 4 * 20 + j + 5e-1 AS x, CAST(floor(tile_id / 4e0) AS BIGINT) * 20 + i + 5e-1 AS y FROM fx_cells),
h AS (SELECT DISTINCT tile_id, i, j FROM (SELECT tile_id, i, j, source_key FROM c JOIN e ON (ay <= y) <> (zy <= y) AND x < ax + (y - ay) * (zx - ax) / (zy - ay) GROUP BY 1, 2, 3, 4 HAVING count(*) % 2 = 1) o)
SELECT c.tile_id, c.i, c.j, h.tile_id IS NOT NULL AS inside FROM c LEFT JOIN h ON h.tile_id = c.tile_id AND h.i = c.i AND h.j = c.j""",
)
def _(t: Tables) -> DataFrame:
    point = lambda p: F.expr("struct(cast({} as double) as x, cast({} as double) as y)".format(*p.split(", ")))
    rings = t.sources.select("source_key", F.array(*map(point, (*_KITE, _KITE[0]))).alias("ring"))
    cells = t.cells.select("tile_id", F.col("i").alias("row"), (F.floor(F.col("tile_id") / 4.0) * 20 + F.col("i")).alias("i"), "j")
    out = outlines.inside_rings(cells, rings, F.col("tile_id") % 4 * 20 + F.col("j") + 0.5, 0.0, 1.0, ring_id=["source_key"])
    return out.select("tile_id", F.col("row").alias("i"), "j", "inside")


@query(
    "g18_nearest_valid",
    f"""WITH v AS (SELECT * FROM fx_cells WHERE size % 17 = 0), h AS (SELECT * FROM fx_cells WHERE size % 17 <> 0),
p AS (SELECT h.tile_id, h.i, h.j, (h.i - v.i) * (h.i - v.i) + (h.j - v.j) * (h.j - v.j) AS d, v.value FROM h JOIN v ON v.tile_id = h.tile_id),
m AS (SELECT tile_id, i, j, min(d) AS d FROM p GROUP BY 1, 2, 3)
SELECT m.tile_id, m.i, m.j, {q6('sqrt(m.d)')} AS distance, min(p.value) AS value FROM m JOIN p USING (tile_id, i, j, d) GROUP BY 1, 2, 3, m.d""",
)
def _(t: Tables) -> DataFrame:
    out = grid.nearest_valid(t.cells.where("size % 17 = 0"), t.cells.where("size % 17 <> 0"))
    return out.select(*K, r6("distance").alias("distance"), "value")


@query("geo9_horizontal_codes", "SELECT c_custkey AS id, CAST(CASE c_custkey % 3 WHEN 0 THEN 32600 + c_custkey % 60 + 1 WHEN 1 THEN 4269 END AS BIGINT) AS epsg FROM customer")
def _(t: Tables) -> DataFrame:
    c = F.col("c_custkey")
    text = F.when(c % 3 == 0, F.concat(F.lit('PROJCS["x",AUTHORITY["EPSG","'), (32600 + c % 60 + 1).cast("string"), F.lit('"]]'))).when(c % 3 == 1, "COMPD NAD83 + NAVD88").otherwise("none")
    return t.customer.select(c.alias("id"), datums.horizontal_epsg(text).alias("epsg"))


@query("geo10_box_text", "SELECT source_key AS id, 'POLYGON ((' || xmin || ' ' || ymin || ', ' || xmax || ' ' || ymin || ', ' || xmax || ' ' || ymax || ', ' || xmin || ' ' || ymax || ', ' || xmin || ' ' || ymin || '))' AS wkt FROM fx_sources")
def _(t: Tables) -> DataFrame:
    return t.sources.select(F.col("source_key").alias("id"), geometry.box_wkt(*(F.col(c) for c in ("xmin", "ymin", "xmax", "ymax"))).alias("wkt"))


@query(
    "f14_bad_values",
    f"""WITH {_BOXES}, r AS (SELECT DISTINCT tile_id, value FROM fx_cells WHERE size = 7),
b AS (SELECT c.tile_id, c.i, c.j, CASE WHEN r.value IS NOT NULL OR c.value - 2e2 >= 0 OR EXISTS (SELECT 1 FROM x WHERE x.tile_id = c.tile_id AND c.i >= i0 AND c.i < i1 AND c.j >= j0 AND c.j < j1) THEN NULL ELSE c.value - 2e2 END AS value
  FROM fx_cells c LEFT JOIN r ON r.tile_id = c.tile_id AND r.value = c.value)
SELECT * FROM b WHERE tile_id IN (SELECT tile_id FROM b WHERE value IS NOT NULL)""",
)
def _(t: Tables) -> DataFrame:
    low = t.cells.select(*K, (F.col("value") - 200).alias("value"), "size")
    null = F.lit(None).cast("double").alias("badvalue")
    exact = low.where("size = 7").select("tile_id", F.col("value").alias("badvalue"), *(F.lit(None).cast("bigint").alias(c) for c in ("i0", "i1", "j0", "j1"))).distinct()
    rules = exact.unionByName(_boxes(t).select("tile_id", null, *(F.col(c).cast("bigint").alias(c) for c in ("i0", "i1", "j0", "j1"))))
    return filters.cleaned(low, rules).select(*K, "value")


@query("g8_nearest_to_targets", f"WITH {_POINTS} SELECT o.id, o.tile_id, o.y, o.x, c.value FROM o LEFT JOIN fx_cells c ON c.tile_id = o.tile_id AND c.i = floor(o.y) AND c.j = floor(o.x)")
def _(t: Tables) -> DataFrame:
    return grid.nearest_at(t.cells, _points(t))


@query(
    "g12_downsampled",
    f"""WITH v AS (SELECT tile_id, i, j, value FROM fx_cells WHERE i + j > 9), e AS (SELECT tile_id, CAST(floor(min(i) / 4e0) * 4 AS BIGINT) AS i0, CAST(floor(min(j) / 4e0) * 4 AS BIGINT) AS j0 FROM v GROUP BY 1),
b AS (SELECT tile_id, CAST(floor(i / 4e0) AS BIGINT) AS bi, CAST(floor(j / 4e0) AS BIGINT) AS bj, avg(value) AS value FROM v GROUP BY 1, 2, 3)
SELECT b.tile_id, e.i0, e.j0, bi - e.i0 // 4 AS i, bj - e.j0 // 4 AS j, {q6('value')} AS value FROM b JOIN e USING (tile_id) WHERE (bi + bj) % 3 > 0""",
)
def _(t: Tables) -> DataFrame:
    land = t.cells.select("tile_id", F.floor(F.col("i") / 4).alias("i"), F.floor(F.col("j") / 4).alias("j")).where("(i + j) % 3 > 0").distinct()
    return grid.downsampled(t.cells.where("i + j > 9"), 4, land).withColumn("value", r6("value"))


@query(
    "g18_cut_and_fill",
    f"""WITH h AS (SELECT tile_id, i, j FROM fx_cells WHERE i BETWEEN 5 AND 8 AND j BETWEEN 3 AND 6), c AS (SELECT * FROM fx_cells WHERE NOT (i BETWEEN 5 AND 8 AND j BETWEEN 3 AND 6))
SELECT tile_id, i, j, {q6('value')} AS value FROM c UNION ALL
SELECT h.tile_id, h.i, h.j, {q6('sum(c.value / sqrt((c.i - h.i) * (c.i - h.i) + (c.j - h.j) * (c.j - h.j))) / sum(1 / sqrt((c.i - h.i) * (c.i - h.i) + (c.j - h.j) * (c.j - h.j)))')} AS value
FROM h JOIN c ON c.tile_id = h.tile_id AND (c.i - h.i) * (c.i - h.i) + (c.j - h.j) * (c.j - h.j) <= 4 GROUP BY 1, 2, 3""",
)
def _(t: Tables) -> DataFrame:
    ring = geometry.box_ring(*(F.lit(float(v)) for v in (3, 5, 7, 9)))
    inside = geometry.contains(ring, F.col("j") + 0.5, F.col("i") + 0.5)
    return grid.cut_and_fill(t.cells, inside, 2).withColumn("value", r6("value"))
