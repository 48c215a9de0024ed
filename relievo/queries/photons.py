"""Queries over photons: filters, classification, cell statistics, outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relievo.operators import filters, grid, joins, ranking, validation
from relievo.queries.registry import Tables, q6, query, r6

#: The grid: 10 degree tiles of 20 by 20 cells, rows counted from 50 N downwards.
_BINNED = """b AS (SELECT *, CAST(floor(longitude / 1e1) AS BIGINT) AS tile_id, (latitude - 5e1) / -5e-1 AS fy,
  (longitude - floor(longitude / 1e1) * 1e1) / 5e-1 AS fx FROM fx_photons),
p AS (SELECT *, CAST(floor(fy) AS BIGINT) AS i, CAST(floor(fx) AS BIGINT) AS j FROM b)"""
_ID = "photon_id, l_partkey, l_suppkey"
_IDS = ["photon_id", "l_partkey", "l_suppkey"]


def binned(photons: DataFrame) -> DataFrame:
    tile = F.floor(F.col("longitude") / 10.0)
    rows = photons.withColumns({"tile_id": tile, "fy": (F.col("latitude") - 50.0) / -0.5, "fx": (F.col("longitude") - tile * 10.0) / 0.5})
    return rows.withColumns({"i": F.floor("fy"), "j": F.floor("fx")})


@query("f1_quality", f"SELECT {_ID}, quality_ph, conf_land, conf_land_ice FROM fx_photons WHERE quality_ph = 0 AND (conf_land = 4 OR conf_land_ice = 4)")
def _(t: Tables) -> DataFrame:
    return filters.good_quality(t.photons).select(*_IDS, "quality_ph", "conf_land", "conf_land_ice")


@query("f2_signal", f"SELECT {_ID}, class_code FROM fx_photons WHERE class_code BETWEEN 1 AND 3")
def _(t: Tables) -> DataFrame:
    return filters.signal(t.photons).select(*_IDS, "class_code")


@query("f3_box_left_closed", f"SELECT {_ID}, longitude, latitude FROM fx_photons WHERE longitude >= 2 AND longitude < 7 AND latitude >= 41 AND latitude < 46")
def _(t: Tables) -> DataFrame:
    return filters.in_box(t.photons, "longitude", "latitude", (2, 41, 7, 46)).select(*_IDS, "longitude", "latitude")


@query("f4_box_raster", f"SELECT {_ID}, class_code FROM fx_photons WHERE longitude >= 0 AND longitude < 10 AND latitude > 40 AND latitude <= 50 AND class_code >= 1")
def _(t: Tables) -> DataFrame:
    return filters.in_box(t.photons, "longitude", "latitude", (0, 40, 10, 50), "raster").where("class_code >= 1").select(*_IDS, "class_code")


@query("f5_box_closed", f"SELECT {_ID}, longitude FROM fx_photons WHERE longitude BETWEEN 2 AND 7 AND latitude BETWEEN 41 AND 46")
def _(t: Tables) -> DataFrame:
    return filters.in_box(t.photons, "longitude", "latitude", (2, 41, 7, 46), "closed").select(*_IDS, "longitude")


@query(
    "f6_outside_boxes",
    f"SELECT {_ID} FROM fx_photons WHERE NOT (longitude BETWEEN 1 AND 3 AND latitude BETWEEN 42 AND 45) AND NOT (longitude BETWEEN 6 AND 9 AND latitude BETWEEN 40 AND 48) AND latitude >= 41",
)
def _(t: Tables) -> DataFrame:
    return filters.outside_boxes(t.photons, "longitude", "latitude", [(1, 42, 3, 45), (6, 40, 9, 48)], 41).select(*_IDS)


@query(
    "f12_band_subset",
    "SELECT CAST(floor(longitude / 2e0) * 2 AS BIGINT) AS lon_bin, count(*) AS n FROM fx_photons WHERE latitude >= 43 AND latitude < 48 GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    return filters.band_subset(t.photons, "longitude", "latitude", 2.0, 43, 48).groupBy(F.col("lon_bin").cast("bigint").alias("lon_bin")).agg(F.count("*").alias("n"))


@query("g1_point_to_cell", f"WITH {_BINNED} SELECT {_ID}, tile_id, i, j FROM p")
def _(t: Tables) -> DataFrame:
    p = t.photons.withColumn("tile_id", F.floor(F.col("longitude") / 10.0))
    x0 = F.col("tile_id") * 10.0
    return p.withColumns({"i": grid.cell_index(F.col("latitude"), F.lit(50.0), F.lit(-0.5)), "j": grid.cell_index(F.col("longitude"), x0, F.lit(0.5))}).select(*_IDS, "tile_id", "i", "j")


@query(
    "j1_photon_classification",
    """WITH s AS (SELECT granule, beam, segment_id, coalesce(sum(cnt) OVER (PARTITION BY granule, beam ORDER BY segment_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM fx_segments),
x AS (SELECT g.granule, g.beam, s.start + g.idx - 1 AS pos, g.flag FROM fx_signal g JOIN s ON s.granule = g.granule AND s.beam = g.beam AND s.segment_id = g.segment_id)
SELECT h.granule, h.beam, h.pos, h.h, CAST(coalesce(x.flag, -1) AS BIGINT) AS class_code FROM fx_heights h LEFT JOIN x ON x.granule = h.granule AND x.beam = h.beam AND x.pos = h.pos""",
)
def _(t: Tables) -> DataFrame:
    return joins.classify(t.heights, t.segments, t.signal).select("granule", "beam", F.col("pos").cast("bigint").alias("pos"), "h", F.col("class_code").cast("bigint").alias("class_code"))


@query(
    "j2_segment_attributes",
    """WITH s AS (SELECT *, coalesce(sum(cnt) OVER (PARTITION BY granule, beam ORDER BY segment_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM fx_segments)
SELECT h.granule, h.beam, h.pos, s.segment_id, h.h - s.geoid AS h_geoid, h.h - (s.geoid + s.free2mean) AS h_meantide, s.seg_dist + h.along AS dist_x
FROM fx_heights h JOIN s ON s.granule = h.granule AND s.beam = h.beam AND h.pos >= s.start AND h.pos < s.start + s.cnt""",
)
def _(t: Tables) -> DataFrame:
    return joins.with_segments(t.heights, t.segments).select("granule", "beam", F.col("pos").cast("bigint").alias("pos"), "segment_id", "h_geoid", "h_meantide", "dist_x")


@query("w1_segment_starts", "SELECT granule, beam, segment_id, CAST(coalesce(sum(cnt) OVER (PARTITION BY granule, beam ORDER BY segment_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM fx_segments")
def _(t: Tables) -> DataFrame:
    return joins.segment_starts(t.segments).select("granule", "beam", "segment_id", F.col("start").cast("bigint").alias("start"))


@query(
    "j3_photons_on_cells",
    f"WITH {_BINNED} SELECT {_ID}, tile_id, i, j, value - h_geoid AS dem_minus_photon FROM p JOIN fx_cells c USING (tile_id, i, j) WHERE class_code = 1",
)
def _(t: Tables) -> DataFrame:
    out = joins.on_cells(binned(t.photons).where("class_code = 1"), t.cells)
    return out.select(*_IDS, "tile_id", "i", "j", (F.col("value") - F.col("h_geoid")).alias("dem_minus_photon"))


@query(
    "j4_occupied_cells",
    f"WITH {_BINNED} SELECT tile_id, i, j, value FROM fx_cells c WHERE land > 0 AND EXISTS (SELECT 1 FROM p WHERE p.tile_id = c.tile_id AND p.i = c.i AND p.j = c.j AND p.class_code = 1)",
)
def _(t: Tables) -> DataFrame:
    return joins.occupied(filters.valid_land(t.cells), binned(t.photons).where("class_code = 1")).select("tile_id", "i", "j", "value")


@query(
    "j5_reject_granules",
    f"WITH r AS (SELECT granule % 7 AS g1, csv_filename % 3 AS g2 FROM fx_rejects GROUP BY 1, 2 HAVING sum(photon_count) % 2 = 0) SELECT {_ID} FROM fx_photons p WHERE NOT EXISTS (SELECT 1 FROM r WHERE g1 = p.granule_id1 AND g2 = p.granule_id2)",
)
def _(t: Tables) -> DataFrame:
    pairs = t.rejects.groupBy((F.col("granule") % 7).alias("granule_id1"), (F.col("csv_filename") % 3).alias("granule_id2"))
    return joins.without_rejected(t.photons, pairs.agg(F.sum("photon_count").alias("n")).where("n % 2 = 0")).select(*_IDS)


_A1 = f"""{_BINNED},
f AS (SELECT * FROM p WHERE quality_ph = 0 AND (conf_land = 4 OR conf_land_ice = 4) AND latitude > 40 AND class_code >= 1),
a AS (SELECT tile_id, i, j, count(*) AS n_all, avg(CASE WHEN class_code >= 2 THEN 1e0 ELSE 0e0 END) AS canopy, count(*) FILTER (WHERE class_code = 1) AS n_ground,
  max(h_geoid) FILTER (WHERE class_code = 1) - min(h_geoid) FILTER (WHERE class_code = 1) AS span,
  quantile_cont(h_geoid, 0.1) FILTER (WHERE class_code = 1) AS p10, quantile_cont(h_geoid, 0.9) FILTER (WHERE class_code = 1) AS p90 FROM f GROUP BY 1, 2, 3),
s AS (SELECT tile_id, i, j, any_value(n_all) AS n_all, any_value(canopy) AS canopy, any_value(n_ground) AS n_ground, any_value(span) AS span, any_value(p10) AS p10, any_value(p90) AS p90,
  count(*) AS n_trim, avg(h_geoid) AS mean, median(h_geoid) AS median, stddev_samp(h_geoid) AS std
  FROM f JOIN a USING (tile_id, i, j) WHERE class_code = 1 AND a.n_ground >= 3 AND h_geoid BETWEEN p10 AND p90 GROUP BY 1, 2, 3),
v AS (SELECT tile_id, i, j, CAST(count(DISTINCT floor((fy - floor(fy)) * 15) * 15 + floor((fx - floor(fx)) * 15)) AS DOUBLE) / 225e0 AS coverage FROM f GROUP BY 1, 2, 3),
r AS (SELECT s.*, c.value - s.mean AS diff_mean, c.value - s.median AS diff_median, v.coverage FROM s JOIN fx_cells c USING (tile_id, i, j) JOIN v USING (tile_id, i, j))"""


def results(t: Tables) -> DataFrame:
    """Cell results with coverage: quality filter, extent, statistics."""
    rows = binned(filters.good_quality(t.photons).where("latitude > 40 and class_code >= 1"))
    stats = validation.cell_statistics(rows, t.cells)
    return stats.join(validation.coverage(rows), ["tile_id", "i", "j"])


@query(
    "a1_cell_statistics",
    f"WITH {_A1} SELECT tile_id, i, j, n_all, {q6('canopy')} AS canopy, n_ground, span, {q6('p10')} AS p10, {q6('p90')} AS p90, n_trim, {q6('mean')} AS mean, {q6('median')} AS median, "
    f"{q6('std')} AS std, {q6('diff_mean')} AS diff_mean, {q6('diff_median')} AS diff_median FROM r",
)
def a1(t: Tables) -> DataFrame:
    rows = binned(filters.good_quality(t.photons).where("latitude > 40 and class_code >= 1"))
    out = validation.cell_statistics(rows, t.cells)
    exact = ("canopy", "p10", "p90", "mean", "median", "std", "diff_mean", "diff_median")
    return out.select("tile_id", "i", "j", "n_all", "n_ground", "span", "n_trim", *(r6(c).alias(c) for c in exact))


@query(
    "a2_coverage",
    f"WITH {_A1} SELECT tile_id, i, j, {q6('coverage')} AS coverage FROM v",
)
def _(t: Tables) -> DataFrame:
    rows = binned(filters.good_quality(t.photons).where("latitude > 40 and class_code >= 1"))
    return validation.coverage(rows).select("tile_id", "i", "j", r6("coverage").alias("coverage"))


@query("a3_capped_photons", f"WITH {_BINNED} SELECT tile_id, i, j, least(count(*), 3) AS n FROM p GROUP BY 1, 2, 3")
def _(t: Tables) -> DataFrame:
    kept = validation.capped(binned(t.photons), 3, ["photon_id", "l_partkey", "l_suppkey"])
    return kept.groupBy("tile_id", "i", "j").agg(F.count("*").alias("n"))


_PCT = ", ".join(f"({k}, {v / 100})" for k, v in enumerate(validation.PERCENTS))


@query(
    "a4_summary",
    f"WITH {_A1} SELECT count(*) AS n_cells, CAST(sum(n_trim) AS BIGINT) AS n_photons, {q6('avg(n_trim)')} AS mean_photons, {q6('avg(diff_mean)')} AS dem_minus_photon, "
    f"{q6('sqrt(avg(diff_mean * diff_mean))')} AS rmse, {q6('avg(canopy)')} AS mean_canopy, {q6('avg(CASE WHEN canopy > 0 THEN 1e0 ELSE 0e0 END)')} AS wooded, "
    f"{q6('avg(canopy) FILTER (WHERE canopy > 0)')} AS wooded_canopy, {q6('avg(std)')} AS roughness FROM r",
)
def a4(t: Tables) -> DataFrame:
    out = validation.summary(results(t))
    exact = ("mean_photons", "dem_minus_photon", "rmse", "mean_canopy", "wooded", "wooded_canopy", "roughness")
    return out.select("n_cells", "n_photons", *(r6(c).alias(c) for c in exact))


@query(
    "a4_percentiles",
    f"WITH {_A1}, k(percent, p) AS (VALUES {', '.join(f'({v}, {v / 100})' for v in validation.PERCENTS)}), q AS (SELECT list(diff_mean ORDER BY diff_mean) AS d FROM r) "
    f"SELECT CAST(percent AS BIGINT) AS percent, {q6('d[CAST(floor(p * (len(d) - 1)) AS BIGINT) + 1] + (p * (len(d) - 1) - floor(p * (len(d) - 1))) * (d[CAST(ceil(p * (len(d) - 1)) AS BIGINT) + 1] - d[CAST(floor(p * (len(d) - 1)) AS BIGINT) + 1])')} AS error FROM k, q",
)
def _(t: Tables) -> DataFrame:
    return validation.long_percentiles(validation.summary(results(t))).select(F.col("percent").cast("bigint").alias("percent"), r6("error").alias("error"))


@query(
    "a5_tile_errors",
    f"""WITH {_A1}, k AS (SELECT tile_id, quantile_cont(coverage, 0.5) AS cutoff FROM r GROUP BY 1)
SELECT tile_id, count(*) AS n_cells, {q6('avg(diff_mean)')} AS bias, {q6('coalesce(stddev_samp(diff_mean), 0e0)')} AS std, {q6('sqrt(avg(diff_mean * diff_mean))')} AS rmse, {q6('any_value(cutoff)')} AS cutoff
FROM r JOIN k USING (tile_id) WHERE coverage >= cutoff GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    out = validation.tile_errors(results(t), top=0.5)
    return out.select("tile_id", "n_cells", *(r6(c).alias(c) for c in ("bias", "std", "rmse", "cutoff")))


@query(
    "a6_by_coverage",
    f"WITH {_A1} SELECT floor(coverage * 1000 + 5e-1) / 1e1 AS coverage_pct, count(*) AS n, {q6('sqrt(avg(diff_mean * diff_mean))')} AS rmse FROM r GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    return validation.by_coverage(results(t)).select("coverage_pct", "n", r6("rmse").alias("rmse"))


@query("f8_reliable_cells", f"WITH {_A1} SELECT tile_id, i, j, n_trim FROM r WHERE n_trim > 3 AND diff_mean IS NOT NULL")
def _(t: Tables) -> DataFrame:
    return filters.reliable(results(t)).select("tile_id", "i", "j", "n_trim")


@query("f9_small_errors", f"WITH {_A1} SELECT tile_id, i, j, {q6('diff_mean')} AS diff_mean FROM r WHERE abs(diff_mean) <= 5000")
def _(t: Tables) -> DataFrame:
    return filters.small_error(results(t), 5000).select("tile_id", "i", "j", r6("diff_mean").alias("diff_mean"))


@query("f10_coverage_levels", f"WITH {_A1} SELECT level, count(*) AS n FROM r, (SELECT unnest([1, 2, 3, 4, 5])::BIGINT AS level) k WHERE coverage >= level / 1e2 GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return filters.coverage_levels(results(t), [1, 2, 3, 4, 5]).groupBy("level").agg(F.count("*").alias("n"))


_ERR = f"{_BINNED}, e AS (SELECT p.*, c.value - h_geoid AS error FROM p JOIN fx_cells c USING (tile_id, i, j) WHERE class_code = 1)"


def errors(t: Tables) -> DataFrame:
    rows = joins.on_cells(binned(t.photons).where("class_code = 1"), t.cells.select("tile_id", "i", "j", "value"))
    return rows.withColumn("error", F.col("value") - F.col("h_geoid"))


@query(
    "a7_by_category",
    f"WITH {_ERR} SELECT CAST(quality_ph AS BIGINT) AS quality_ph, conf_land, count(*) AS n, {q6('avg(error)')} AS mean, {q6('stddev_pop(error)')} AS std FROM e GROUP BY GROUPING SETS ((), (quality_ph), (conf_land))",
)
def _(t: Tables) -> DataFrame:
    return validation.by_category(errors(t), ["quality_ph", "conf_land"]).select("quality_ph", "conf_land", "n", r6("mean").alias("mean"), r6("std").alias("std"))


@query(
    "a8_granule_errors",
    f"""WITH {_ERR}, k AS (SELECT quantile_cont(error, 0.0005) AS lo, quantile_cont(error, 0.9995) AS hi FROM e)
SELECT granule_id1, granule_id2, count(*) AS n, {q6('avg(error)')} AS mean, {q6('stddev_samp(error)')} AS std FROM e, k WHERE error BETWEEN lo AND hi GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    return validation.granule_errors(errors(t)).select("granule_id1", "granule_id2", "n", r6("mean").alias("mean"), r6("std").alias("std"))


@query(
    "a9_outlier_granules",
    """WITH g AS (SELECT granule_id1, count(*) AS n, avg(h_geoid + CASE WHEN granule_id1 = 3 THEN 5e4 ELSE 0e0 END) AS mean,
  stddev_samp(h_geoid + CASE WHEN granule_id1 = 3 THEN 5e4 ELSE 0e0 END) AS std FROM fx_photons GROUP BY 1),
w AS (SELECT * FROM g WHERE n >= 20),
c AS (SELECT a.granule_id1, count(*) AS n_compared, count(*) FILTER (WHERE a.mean + 2 * a.std < b.mean - 2 * b.std OR b.mean + 2 * b.std < a.mean - 2 * a.std) AS n_apart
  FROM w a JOIN w b ON a.granule_id1 <> b.granule_id1 GROUP BY 1)
SELECT granule_id1, n_apart, n_compared FROM c WHERE n_apart >= 3 AND n_apart >= n_compared - 1""",
)
def _(t: Tables) -> DataFrame:
    h = F.col("h_geoid") + F.when(F.col("granule_id1") == 3, 5e4).otherwise(0.0)
    stats = t.photons.groupBy("granule_id1").agg(F.count("*").alias("n"), F.avg(h).alias("mean"), F.stddev_samp(h).alias("std"))
    return validation.outlier_granules(stats, ["granule_id1"])


@query("a10_reject_list", "SELECT granule, count(*) AS n_files, CAST(sum(photon_count) AS BIGINT) AS n_photons FROM fx_rejects GROUP BY 1 HAVING count(*) >= 2 AND sum(photon_count) >= 1000")
def _(t: Tables) -> DataFrame:
    return validation.reject_list(t.rejects)


@query(
    "a11_tile_counts",
    f"WITH {_BINNED} SELECT tile_id, count(*) AS numphotons, count(*) FILTER (WHERE class_code BETWEEN 2 AND 3) AS numphotons_canopy, count(*) FILTER (WHERE class_code = 1) AS numphotons_ground FROM p GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    return validation.tile_counts(binned(t.photons))


@query(
    "a12_flag_summary",
    f"""WITH s AS (SELECT count(*) AS n, count(*) FILTER (WHERE quality_ph = 0) AS a, count(*) FILTER (WHERE conf_land = 4) AS b, count(*) FILTER (WHERE conf_land = 4 AND conf_land_ice < 4) AS c FROM fx_photons)
SELECT f.flag, f.n_true, s.n AS n_all, {q6('1e2 * f.n_true / s.n')} AS percent FROM s, LATERAL (VALUES ('passed', a), ('land', b), ('land_only', c)) f(flag, n_true)""",
)
def _(t: Tables) -> DataFrame:
    flags = {"passed": F.col("quality_ph") == 0, "land": F.col("conf_land") == 4, "land_only": (F.col("conf_land") == 4) & (F.col("conf_land_ice") < 4)}
    return validation.flag_summary(t.photons, flags).withColumn("percent", r6("percent"))


@query(
    "a19_error_histogram",
    f"WITH {_ERR}, h AS (SELECT CAST(least(49, floor((error - -15000e0) * 50 / 30000e0)) AS BIGINT) AS bin, count(*) AS n FROM e WHERE error BETWEEN -15000 AND 15000 GROUP BY 1) SELECT bin, n, CAST(sum(n) OVER (ORDER BY bin) AS BIGINT) AS running FROM h",
)
def _(t: Tables) -> DataFrame:
    return validation.histogram(errors(t), "error", -15000.0, 15000.0, 50)


@query(
    "a19_error_marks",
    f"WITH {_ERR} SELECT count(*) AS n, {q6('avg(error)')} AS mean, {q6('stddev_pop(error)')} AS std, {q6('quantile_cont(error, 0.01)')} AS p01, {q6('quantile_cont(error, 0.99)')} AS p99, {q6('sqrt(avg(error * error))')} AS rmse FROM e",
)
def _(t: Tables) -> DataFrame:
    out = validation.error_marks(errors(t), "error")
    return out.select("n", *(r6(c).alias(c) for c in ("mean", "std", "p01", "p99", "rmse")))


@query(
    "a20_granule_histograms",
    f"WITH {_ERR}, h AS (SELECT granule_id1, CAST(least(199, floor((error - -15000e0) * 200 / 30000e0)) AS BIGINT) AS bin, count(*) AS n FROM e WHERE error BETWEEN -15000 AND 15000 GROUP BY 1, 2) SELECT granule_id1, bin, n, CAST(sum(n) OVER (PARTITION BY bin ORDER BY granule_id1) AS BIGINT) AS running FROM h",
)
def _(t: Tables) -> DataFrame:
    return validation.histogram(errors(t), "error", -15000.0, 15000.0, 200, ["granule_id1"])


@query("a23_bounds", "SELECT beam, min(longitude) AS xmin, min(latitude) AS ymin, max(longitude) AS xmax, max(latitude) AS ymax FROM fx_photons GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return validation.bounds(t.photons, "longitude", "latitude", ["beam"])


@query(
    "a26_catalogue_audit",
    f"""WITH {_BINNED}, n AS (SELECT tile_id, count(*) AS a, count(*) FILTER (WHERE class_code BETWEEN 2 AND 3) AS c, count(*) FILTER (WHERE class_code = 1) AS g FROM p GROUP BY 1),
k AS (SELECT tile_id, a + CASE WHEN tile_id % 3 = 0 THEN 1 ELSE 0 END AS ra, c AS rc, g AS rg FROM n)
SELECT tile_id, ra AS recorded_numphotons, a AS numphotons, ra = rc + rg AS added_up FROM k JOIN n USING (tile_id) WHERE ra <> a""",
)
def _(t: Tables) -> DataFrame:
    counted = validation.tile_counts(binned(t.photons))
    recorded = counted.withColumn("numphotons", F.col("numphotons") + F.when(F.col("tile_id") % 3 == 0, 1).otherwise(0))
    return validation.audit(recorded, counted).select("tile_id", "recorded_numphotons", "numphotons", "added_up")


@query(
    "a27_regional_errors",
    f"WITH {_A1} SELECT region, count(*) AS n_cells, {q6('avg(diff_mean)')} AS bias, {q6('sqrt(avg(diff_mean * diff_mean))')} AS rmse FROM r JOIN (SELECT DISTINCT tile_id, tile_id % 3 AS region FROM fx_cells) g USING (tile_id) GROUP BY ROLLUP (region)",
)
def _(t: Tables) -> DataFrame:
    regions = t.cells.select("tile_id", (F.col("tile_id") % 3).alias("region")).distinct()
    return validation.regional(results(t), regions, "tile_id").select("region", "n_cells", r6("bias").alias("bias"), r6("rmse").alias("rmse"))


@query(
    "a21_progress",
    f"WITH {_BINNED}, s AS (SELECT tile_id, i, j, CASE WHEN count(*) FILTER (WHERE class_code = 1) >= 3 THEN 2 WHEN count(*) FILTER (WHERE class_code >= 1) > 0 THEN 1 ELSE 0 END AS status FROM p GROUP BY 1, 2, 3) SELECT CAST(status AS BIGINT) AS status, count(*) AS n, {q6('1e2 * count(*) / (SELECT count(*) FROM s)')} AS percent FROM s GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    c = F.col("class_code")
    cells = binned(t.photons).groupBy("tile_id", "i", "j").agg(F.count_if(c == 1).alias("g"), F.count_if(c >= 1).alias("a"))
    return validation.progress(cells.withColumn("status", F.expr("case when g >= 3 then 2 when a > 0 then 1 else 0 end"))).withColumn("percent", r6("percent"))


@query(
    "a22_box_status",
    f"""WITH {_A1}, x AS (SELECT tile_id, count(*) AS n_cells, sqrt(avg(diff_mean * diff_mean)) AS rmse FROM r GROUP BY 1), bx AS (SELECT DISTINCT tile_id FROM fx_cells UNION SELECT n_nationkey + 900000 FROM nation)
SELECT tile_id, {q6('rmse')} AS rmse, CASE WHEN tile_id >= 900010 THEN 'EMPTY' WHEN n_cells IS NOT NULL THEN 'DONE' ELSE 'PENDING' END AS status FROM bx LEFT JOIN x USING (tile_id)""",
)
def _(t: Tables) -> DataFrame:
    boxes = t.cells.select("tile_id").union(t.nation.select((F.col("n_nationkey") + 900000).cast("bigint").alias("tile_id"))).distinct()
    boxes = boxes.withColumn("is_empty", F.col("tile_id") >= 900010)
    return validation.box_status(boxes, results(t), "tile_id").select("tile_id", r6("rmse").alias("rmse"), "status")


@query(
    "w9_surface_rule",
    f"""WITH k AS (SELECT *, (dist_x - min(dist_x) OVER (PARTITION BY granule_id1, beam)) / 1e3 AS km FROM fx_photons),
l AS (SELECT *, floor(km / 5e-2) AS step, km * 1e1 + 2e3 AS line FROM k),
a AS (SELECT *, CASE WHEN class_code IN (2, 3) THEN CASE WHEN abs(h_geoid - line) <= 2e3 THEN 4 ELSE 0 END ELSE class_code END AS c1 FROM l),
b AS (SELECT *, count(*) FILTER (WHERE c1 = 4) OVER (PARTITION BY granule_id1, beam, step) AS surface FROM a),
c AS (SELECT *, CASE WHEN surface <= 1 AND c1 = 1 AND h_geoid > line - 2e3 THEN 4 ELSE c1 END AS c2 FROM b),
d AS (SELECT *, count(*) FILTER (WHERE c2 = 1) OVER (PARTITION BY granule_id1, beam, step) AS ground FROM c)
SELECT {_ID}, CAST(CASE WHEN surface <= 1 AND ground <= 3 AND c2 = 1 THEN 4 ELSE c2 END AS BIGINT) AS class_code FROM d""",
)
def _(t: Tables) -> DataFrame:
    return ranking.surface_rule(t.photons, 10.0, 2000.0, half=2000.0).select(*_IDS, F.col("class_code").cast("bigint").alias("class_code"))


@query(
    "w10_band_rules",
    f"""WITH k AS (SELECT *, (dist_x - min(dist_x) OVER (PARTITION BY granule_id1, beam)) / 1e3 AS km FROM fx_photons),
r AS (SELECT CAST(n_nationkey AS BIGINT) AS rule_no, n_nationkey * 9e-1 AS d0, n_nationkey * 9e-1 + 2e0 AS d1, CAST(n_nationkey % 5 AS BIGINT) AS new_class FROM nation),
h AS (SELECT {_ID}, arg_max(new_class, rule_no) AS new_class FROM k JOIN r ON km BETWEEN d0 AND d1 AND h_geoid BETWEEN 2e0 * km + 4e3 - 1e3 AND 2e0 * km + 4e3 + 15e2 GROUP BY 1, 2, 3)
SELECT {_ID}, coalesce(new_class, class_code) AS class_code FROM k LEFT JOIN h USING ({_ID})""",
)
def _(t: Tables) -> DataFrame:
    n = F.col("n_nationkey")
    rules = t.nation.select(
        n.cast("bigint").alias("rule_no"), (n * 0.9).alias("d0"), (n * 0.9 + 2.0).alias("d1"), F.lit(2.0).alias("slope"), F.lit(4000.0).alias("intercept"),
        F.lit(1000.0).alias("below"), F.lit(1500.0).alias("above"), (n % 5).cast("bigint").alias("new_class"),
    )
    return ranking.reclassify(ranking.rebased(t.photons, ["granule_id1", "beam"]), rules, _IDS).select(*_IDS, "class_code")


@query("w11_rebased_distance", f"SELECT {_ID}, {q6('(dist_x - min(dist_x) OVER (PARTITION BY granule_id1, beam)) / 1e3')} AS km FROM fx_photons")
def _(t: Tables) -> DataFrame:
    return ranking.rebased(t.photons, ["granule_id1", "beam"]).select(*_IDS, r6("km").alias("km"))


@query(
    "u4_append_new",
    "SELECT granule, csv_filename, photon_count FROM fx_rejects WHERE csv_filename < 20 UNION ALL SELECT granule, csv_filename, photon_count FROM fx_rejects WHERE csv_filename >= 10 AND csv_filename NOT IN (SELECT csv_filename FROM fx_rejects WHERE csv_filename < 20)",
)
def _(t: Tables) -> DataFrame:
    return ranking.append_new(t.rejects.where("csv_filename < 20"), t.rejects.where("csv_filename >= 10"), "csv_filename")


@query("g20_height_choice", f"SELECT {_ID}, h_meantide AS height FROM fx_photons")
def _(t: Tables) -> DataFrame:
    return t.photons.select(*_IDS, grid.height("meantide").alias("height"))


@query(
    "x5_collection_validation",
    f"WITH {_A1} SELECT tile_id, count(*) AS n_cells, CAST(sum(n_trim) AS BIGINT) AS n_photons, {q6('avg(diff_mean)')} AS dem_minus_photon, {q6('sqrt(avg(diff_mean * diff_mean))')} AS rmse FROM r GROUP BY ROLLUP (tile_id)",
)
def _(t: Tables) -> DataFrame:
    rows = results(t)
    return validation.collection_summary(rows).select("tile_id", "n_cells", "n_photons", r6("dem_minus_photon").alias("dem_minus_photon"), r6("rmse").alias("rmse"))
