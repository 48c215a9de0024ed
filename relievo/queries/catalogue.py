"""Queries over tiles, sources, names and registries; incremental jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relievo.functions import datums, names
from relievo.operators import collections, filters, grid, joins, ranking, validation
from relievo.plans.ranges import overlap_join
from relievo.plans.storage import new_folder
from relievo.queries.photons import binned
from relievo.queries.registry import Tables, q6, query, r6
from relievo.sources import clustered, readers, writers
from relievo.streaming import jobs

_MEETS = "t.xmin < s.xmax AND t.xmax > s.xmin AND t.ymin < s.ymax AND t.ymax > s.ymin"


@query("j6_tile_overlap", f"SELECT t.tile_id, s.source_key FROM fx_tiles t JOIN fx_sources s ON {_MEETS}")
def _(t: Tables) -> DataFrame:
    return overlap_join(t.tiles, t.sources, 15).select("l.tile_id", "r.source_key")


@query(
    "j7_raster_footprint",
    "WITH g AS (SELECT source_key AS id, xmin AS gx0, ymin AS gy0, xmin + 3 AS gx1, ymin + 2 AS gy1 FROM fx_sources) SELECT g.id, t.tile_id FROM fx_tiles t JOIN g ON t.xmin < gx1 AND t.xmax > gx0 AND t.ymin < gy1 AND t.ymax > gy0",
)
def _(t: Tables) -> DataFrame:
    rasters = t.sources.select(
        F.col("source_key").alias("id"), F.col("xmin").cast("double").alias("xleft"), (F.col("ymin") + 2).cast("double").alias("ytop"),
        F.lit(0.25).alias("xres"), F.lit(-0.25).alias("yres"), F.lit(12).alias("xsize"), F.lit(8).alias("ysize"),
    )
    return overlap_join(grid.corners(rasters), t.tiles, 15).select("l.id", "r.tile_id")


_DATALIST = f"SELECT t.tile_id, s.filename, r.ranking_score AS weight, r.dset_name FROM fx_tiles t JOIN fx_sources s ON {_MEETS} JOIN fx_registry r ON r.id_number = s.source_id WHERE r.is_active AND NOT (t.ymin < 15 AND r.region = 2)"


def datalists(t: Tables) -> DataFrame:
    registry = t.registry
    excluded = (F.col("l.ymin") < 15) & F.col("id").isin([r["id_number"] for r in registry.where("region = 2").collect()])  # 13 rows at most
    return joins.datalist(t.tiles, t.sources, registry, 15, excluded)


@query("j8_datalists", _DATALIST)
def _(t: Tables) -> DataFrame:
    return datalists(t)


@query("s11_datalist_lines", f"SELECT tile_id, filename || ' 200 ' || weight AS line, filename AS path, CAST(200 AS BIGINT) AS format, CAST(weight AS DOUBLE) AS weight FROM ({_DATALIST}) d")
def _(t: Tables) -> DataFrame:
    rows = datalists(t).withColumn("line", names.datalist_line(F.col("filename"), F.col("weight")))
    return rows.select("tile_id", "line", names.parse_datalist(F.col("line")).alias("p")).select("tile_id", "line", "p.path", "p.format", "p.weight")


def _products(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = t.granule_names.withColumn("granule", F.regexp_extract("name", r"^ATL0[38]_(\d{14}_\d{4})", 1))
    return rows.where("name like 'ATL03%'"), rows.where("name like 'ATL08%'")


_G = "g AS (SELECT name, regexp_extract(name, '^ATL0[38]_([0-9]{14}_[0-9]{4})', 1) AS granule FROM fx_granule_names)"


@query("j9_matched_granules", f"WITH {_G} SELECT DISTINCT granule FROM g WHERE name LIKE 'ATL03%' AND granule IN (SELECT granule FROM g WHERE name LIKE 'ATL08%')")
def _(t: Tables) -> DataFrame:
    a, b = _products(t)
    return joins.matched(a, b, "granule", 0.0)


@query("u3_common_granules", f"WITH {_G} SELECT granule FROM g WHERE name LIKE 'ATL03%' INTERSECT SELECT granule FROM g WHERE name LIKE 'ATL08%'")
def _(t: Tables) -> DataFrame:
    a, b = _products(t)
    return a.select("granule").intersect(b.select("granule"))


@query(
    "j10_missing_companions",
    f"WITH {_G}, a AS (SELECT DISTINCT granule FROM g WHERE name LIKE 'ATL03%'), b AS (SELECT DISTINCT granule FROM g WHERE name LIKE 'ATL08%') SELECT coalesce(a.granule, b.granule) AS granule, CASE WHEN a.granule IS NULL THEN 'a' ELSE 'b' END AS missing_in FROM a FULL JOIN b ON a.granule = b.granule WHERE a.granule IS NULL OR b.granule IS NULL",
)
def _(t: Tables) -> DataFrame:
    return joins.missing_companions(*_products(t), "granule")


@query(
    "s4_granule_numbers",
    "SELECT key, CAST(regexp_extract(name, '^ATL0[38]_([0-9]{14})', 1) AS BIGINT) AS id1, CAST(regexp_extract(name, '^ATL0[38]_[0-9]{14}_([0-9]{8})', 1) || regexp_extract(name, '_([0-9]{3})_[0-9]{2}.h5$', 1) || regexp_extract(name, '_([0-9]{2}).h5$', 1) AS BIGINT) AS id2, CAST(regexp_extract(name, '_([0-9]{3})_[0-9]{2}.h5$', 1) AS BIGINT) AS version, 'ATL03' || substr(name, 6) AS name FROM fx_granule_names",
)
def _(t: Tables) -> DataFrame:
    rows = t.granule_names.withColumn("n", names.granule_numbers(F.col("name")))
    return rows.select("key", "n.id1", "n.id2", names.granule_version(F.col("name")).alias("version"), names.granule_name(F.col("n.id1"), F.col("n.id2")).alias("name"))


@query("s5_product_swap", "SELECT key, CASE WHEN name LIKE 'ATL03%' THEN replace(name, 'ATL03', 'ATL08') ELSE replace(name, 'ATL08', 'ATL03') END AS name FROM fx_granule_names")
def _(t: Tables) -> DataFrame:
    return t.granule_names.select("key", names.other_product(F.col("name")).alias("name"))


@query("s6_beams", "SELECT beam, ['gt1l', 'gt1r', 'gt2l', 'gt2r', 'gt3l', 'gt3r'][beam + 1] AS name, beam AS code, count(*) AS n FROM fx_photons GROUP BY beam")
def _(t: Tables) -> DataFrame:
    rows = t.photons.groupBy("beam").agg(F.count("*").alias("n")).withColumn("name", names.beam_name(F.col("beam")))
    return rows.select("beam", "name", names.beam_code(F.col("name")).alias("code"), "n")


@query("s21_region_numbers", "SELECT key, CAST(regexp_extract(name, '_[0-9]{6}([0-9]{2})_[0-9]{3}_[0-9]{2}', 1) AS BIGINT) AS region FROM fx_granule_names")
def _(t: Tables) -> DataFrame:
    return t.granule_names.select("key", names.region_number(F.col("name")).alias("region"))


_TAG = "CAST(substr(tag, 2, 2) AS BIGINT) * CASE WHEN substr(tag, 1, 1) = 'S' THEN -1 ELSE 1 END AS y, CAST(substr(tag, 5, 3) AS BIGINT) * CASE WHEN substr(tag, 4, 1) = 'W' THEN -1 ELSE 1 END AS x"


@query("s1_tile_tags", f"SELECT key, {_TAG}, CASE WHEN substr(tag, 1, 3) = 'S00' THEN 'N00' ELSE substr(tag, 1, 3) END || CASE WHEN substr(tag, 4) = 'W000' THEN 'E000' ELSE substr(tag, 4) END AS tag FROM fx_files")
def _(t: Tables) -> DataFrame:
    rows = t.files.select("key", names.tag_corner(F.col("tag")).alias("c"))
    return rows.select("key", "c.y", "c.x", names.tile_tag(F.col("c.y"), F.col("c.x")).alias("tag"))


@query(
    "s2_photon_tile_names",
    "SELECT DISTINCT 'photon_tile_N' || printf('%05.2f', floor(latitude * 4) / 4) || '_E' || printf('%06.2f', floor(longitude * 4) / 4) AS tile FROM fx_photons",
)
def _(t: Tables) -> DataFrame:
    quarter = lambda c: F.floor(F.col(c) * 4) / 4
    return t.photons.select(names.photon_tile_name(quarter("latitude"), quarter("longitude")).alias("tile")).distinct()


@query("s3_one_degree_boxes", f"SELECT key, x AS xmin, y AS ymin, x + 1 AS xmax, y + 1 AS ymax FROM (SELECT key, {_TAG} FROM fx_files) s")
def _(t: Tables) -> DataFrame:
    return t.files.select("key", names.one_degree_box(F.concat(F.lit("land_"), F.col("tag"), F.lit(".tif"))).alias("b")).select("key", "b.*")


@query(
    "s7_bin_suffixes",
    "WITH b AS (SELECT key, CAST(floor(x / 2e0) * 2 AS BIGINT) AS low FROM (SELECT key, " + _TAG + " FROM fx_files) s) SELECT key, '_' || CASE WHEN low < 0 THEN 'W' ELSE 'E' END || lpad(CAST(abs(low) AS STRING), 3, '0') || '_' || CASE WHEN low + 2 < 0 THEN 'W' ELSE 'E' END || lpad(CAST(abs(low + 2) AS STRING), 3, '0') AS suffix FROM b",
)
def _(t: Tables) -> DataFrame:
    return t.files.select("key", names.bin_suffix(names.tag_corner(F.col("tag"))["x"], 2).alias("suffix"))


@query(
    "s8_release_names",
    "WITH s AS (SELECT key, tag, " + _TAG + " FROM fx_files), n AS (SELECT key, y + 15 AS y, x FROM s) SELECT key, CASE WHEN key % 7 <> 0 THEN 'tile_' || CASE WHEN y < 0 THEN 'S' ELSE 'N' END || printf('%02d', abs(y)) || CASE WHEN x < 0 THEN 'W' ELSE 'E' END || lpad(CAST(abs(x) AS STRING), 3, '0') || '_surface.tif' END AS name FROM n",
)
def _(t: Tables) -> DataFrame:
    tail = F.when(F.col("key") % 7 == 0, "_w.tif").otherwise("_surface_2022.09.29.tif")
    return t.files.select("key", names.release_name(F.concat(F.lit("tile_"), F.col("tag"), tail), F.lit(15)).alias("name"))


@query(
    "s8_release_paths",
    "WITH s AS (SELECT key, tag, " + _TAG + """ FROM fx_files),
n AS (SELECT key, tag, y + 15 AS y, x, CASE size_class WHEN 0 THEN 15 WHEN 1 THEN 30 WHEN 2 THEN 60 ELSE 1 END AS res, suffix, ext FROM (
  SELECT *, key % 4 AS size_class, CASE key % 5 WHEN 0 THEN '' WHEN 1 THEN '_bed' WHEN 2 THEN '_geoid' WHEN 3 THEN '_sid' ELSE '_w' END AS suffix, CASE key % 3 WHEN 0 THEN '.tif' WHEN 1 THEN '.nc' ELSE '.txt' END AS ext FROM s) q)
SELECT key, CASE WHEN suffix <> '_w' AND ext <> '.txt' AND res <> 1 AND NOT (suffix = '_sid' AND res > 15) THEN
  CASE ext WHEN '.tif' THEN 'gtif' ELSE 'netcdf' END || '/' || res || 's/' || res || 's_' || CASE suffix WHEN '_geoid' THEN 'geoid' WHEN '_bed' THEN 'bed_elev' WHEN '_sid' THEN 'surface_sid' ELSE 'surface_elev' END || '_' || CASE ext WHEN '.tif' THEN 'gtif' ELSE 'netcdf' END
  || '/relief_v1_' || res || 's_' || CASE WHEN res = 15 THEN CASE WHEN y < 0 THEN 'S' ELSE 'N' END || printf('%02d', abs(y)) || CASE WHEN x < 0 THEN 'W' ELSE 'E' END || lpad(CAST(abs(x) AS STRING), 3, '0') ELSE 'N90W180' END
  || CASE suffix WHEN '' THEN '_surface' WHEN '_sid' THEN '_surface_sid' ELSE suffix END || ext END AS path FROM n""",
)
def _(t: Tables) -> DataFrame:
    pick = lambda n, *v: F.get(F.array(*map(F.lit, v)), (F.col("key") % n).cast("int"))
    name = F.concat(F.lit("relief_v1_"), pick(4, "15", "30", "60", "1"), F.lit("s_"), F.col("tag"), F.lit("_2022.09.29"), pick(5, "", "_bed", "_geoid", "_sid", "_w"), pick(3, ".tif", ".nc", ".txt"))
    return t.files.select("key", names.release_path(name).alias("path"))


@query("s9_chart_names", "SELECT key, 'ncei1_n' || lpad(CAST(20 + key % 30 AS STRING), 2, '0') || 'x' || lpad(CAST(key % 4 * 25 AS STRING), 2, '0') || '_w' || lpad(CAST(60 + key % 60 AS STRING), 3, '0') || 'x' || lpad(CAST(size % 4 * 25 AS STRING), 2, '0') || '_2022v1' AS name FROM fx_files")
def _(t: Tables) -> DataFrame:
    y, x = 20 + F.col("key") % 30 + (F.col("key") % 4) * 0.25, -(60 + F.col("key") % 60 + (F.col("size") % 4) * 0.25)
    return t.files.select("key", names.chart_name(y, x, 2022).alias("name"))


@query("s10_date_stamps", "SELECT o_orderkey AS key, 'tile_' || o_orderkey || '_' || strftime(o_orderdate, '%Y.%m.%d') || '.tif' AS name, strftime(o_orderdate, '%Y.%m.%d') AS stamp FROM orders")
def _(t: Tables) -> DataFrame:
    name = names.dated(F.concat(F.lit("tile_"), F.col("o_orderkey").cast("string"), F.lit(".tif")), F.col("o_orderdate"))
    return t.orders.select(F.col("o_orderkey").alias("key"), name.alias("name"), names.date_stamp(name).alias("stamp"))


@query(
    "s12_datum_codes",
    """SELECT key, CAST(CASE WHEN size % 4 = 0 THEN size ELSE CASE size % 9 WHEN 0 THEN 5703 WHEN 1 THEN 7912 WHEN 2 THEN 6641 WHEN 3 THEN 6644 WHEN 4 THEN 6643 WHEN 5 THEN 3855 WHEN 6 THEN 5174 WHEN 7 THEN 9245 END END AS BIGINT) AS epsg FROM fx_files""",
)
def _(t: Tables) -> DataFrame:
    listed = F.array(*map(F.lit, ("navd88", " WGS84 ", "vivd09", "guvd04", "asvd02", "EGM2008", "msl", "cgvd2013(cgg2013a)", "mhw")))
    name = F.when(F.col("size") % 4 == 0, F.col("size").cast("string")).otherwise(F.get(listed, F.col("size") % 9))
    return t.files.select("key", datums.vertical_epsg(name).alias("epsg"))


@query("s13_path_datums", "SELECT key, CASE WHEN contains(lower(filename), 'navd88') THEN 'navd88' WHEN contains(lower(filename), 'mhw') THEN 'mhw' END AS datum FROM fx_files")
def _(t: Tables) -> DataFrame:
    return t.files.select("key", datums.datum_of_path(F.col("filename")).alias("datum"))


@query("a25_datum_codes", "SELECT nullif(lower(regexp_extract(filename, '(?i)_(navd88|mhhw|mhw|mllw|msl|prvd02)[_.]', 1)), '') AS datum, count(*) AS n FROM fx_files GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return t.files.groupBy(datums.datum_code(F.col("filename")).alias("datum")).agg(F.count("*").alias("n"))


@query("s14_epoch_times", "SELECT photon_id, l_partkey, l_suppkey, epoch_us(make_timestamp(CAST((dist_x * 1e3 + 1514764800) * 1000000 AS BIGINT))) AS us FROM fx_photons")
def _(t: Tables) -> DataFrame:
    return t.photons.select("photon_id", "l_partkey", "l_suppkey", F.unix_micros(datums.epoch_time(F.col("dist_x") * 1e3)).alias("us"))


#: The four links of an entry: href, relation, whether inherited, title.
_LINKS = """SELECT user_id AS feed, event_id, 0 AS place, 'https://data.example/' || event_type || '/' || event_id % 40 || '.h5' AS href, 'https://data.example/rel/data#' AS rel, CASE WHEN event_id % 6 = 0 THEN true WHEN event_id % 6 < 3 THEN false END AS inherited, CASE WHEN event_type = 'error' THEN 'Use OPeNDAP here' WHEN event_type = 'click' THEN 'Download' END AS title FROM events
UNION ALL SELECT user_id, event_id, 1, 'https://mirror.example/' || event_id % 40 || '.h5', CASE WHEN event_id % 3 = 0 THEN 'https://data.example/rel/metadata#' WHEN event_id % 3 = 1 THEN 'data' END, NULL, NULL FROM events
UNION ALL SELECT user_id, event_id, 2, 'https://data.example/browse/' || event_id || '.jpg', 'https://data.example/rel/browse#', false, 'Browse' FROM events
UNION ALL SELECT user_id, event_id, 3, NULL, 'https://data.example/rel/data#', false, NULL FROM events"""


@query(
    "s17_catalogue_links",
    f"""WITH l AS ({_LINKS}),
k AS (SELECT *, regexp_extract(href, '[^/]*$', 0) AS file FROM l WHERE href IS NOT NULL AND inherited IS NOT TRUE AND (rel IS NULL OR contains(rel, 'data#')) AND (title IS NULL OR NOT contains(lower(title), 'opendap')))
SELECT feed, event_id, place, href FROM (SELECT *, row_number() OVER (PARTITION BY feed, file ORDER BY event_id, place) AS o FROM k) s WHERE o = 1""",
)
def _(t: Tables) -> DataFrame:
    e, site = F.col("event_id"), "https://data.example/"
    file = F.concat((e % 40).cast("string"), F.lit(".h5"))
    link = lambda href, rel, inherited, title: F.struct(href.alias("href"), rel.alias("rel"), inherited.cast("boolean").alias("inherited"), title.cast("string").alias("title"))
    links = F.array(
        link(F.concat(F.lit(site), "event_type", F.lit("/"), file), F.lit(f"{site}rel/data#"), F.when(e % 6 == 0, True).when(e % 6 < 3, False), F.when(F.col("event_type") == "error", "Use OPeNDAP here").when(F.col("event_type") == "click", "Download")),
        link(F.concat(F.lit("https://mirror.example/"), file), F.when(e % 3 == 0, f"{site}rel/metadata#").when(e % 3 == 1, "data"), F.lit(None), F.lit(None)),
        link(F.concat(F.lit(f"{site}browse/"), e.cast("string"), F.lit(".jpg")), F.lit(f"{site}rel/browse#"), F.lit(False), F.lit("Browse")),
        link(F.lit(None).cast("string"), F.lit(f"{site}rel/data#"), F.lit(False), F.lit(None)),
    )
    entry = F.from_json(F.to_json(F.struct(links.alias("links"))), "links array<struct<href string, rel string, inherited boolean, title string>>")
    return collections.data_links(t.events.select(F.col("user_id").alias("feed"), "event_id", entry["links"].alias("links")), "event_id", by=["feed"]).select("feed", "event_id", "place", "href")


@query("s19_error_measures", f"SELECT l_suppkey, {q6('sqrt(avg(l_discount * l_discount))')} AS rmse, {q6('avg(l_discount)')} AS bias, {q6('avg(cos(radians(l_quantity)))')} AS weight FROM lineitem GROUP BY 1")
def _(t: Tables) -> DataFrame:
    from relievo.functions import geometry

    return t.lineitem.groupBy("l_suppkey").agg(
        r6(geometry.rmse(F.col("l_discount"))).alias("rmse"), r6(F.avg("l_discount")).alias("bias"), r6(F.avg(geometry.latitude_weight(F.col("l_quantity")))).alias("weight")
    )


@query("s20_longitude_bins", "SELECT CAST(floor(longitude / 25e-1) AS BIGINT) AS bin, count(*) AS n FROM fx_photons GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return validation.longitude_bins(t.photons)


@query("f13_name_filters", "SELECT key, filename FROM fx_files WHERE regexp_matches(filename, 'ncei1_.*2019') AND NOT regexp_matches(filename, 'MHW')")
def _(t: Tables) -> DataFrame:
    return filters.by_name(t.files, "filename", "ncei1_.*2019", "MHW").select("key", "filename")


@query("j12_bed_substitution", "WITH b AS (SELECT CAST(s_nationkey AS BIGINT) AS tile_id, min(s_name) AS bed, count(*) AS n FROM supplier GROUP BY 1) SELECT t.tile_id, CASE WHEN n = 1 THEN bed ELSE tile_name END AS filename FROM fx_tiles t LEFT JOIN b USING (tile_id)")
def _(t: Tables) -> DataFrame:
    beds = t.supplier.select(F.col("s_nationkey").cast("bigint").alias("tile_id"), F.col("s_name").alias("filename"))
    return joins.substituted(t.tiles.select("tile_id", F.col("tile_name").alias("filename")), beds).select("tile_id", "filename")


@query("j13_tile_scheme", "SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS tile_id, CAST(32600 + c_nationkey % 60 + 1 AS BIGINT) AS epsg FROM customer")
def _(t: Tables) -> DataFrame:
    scheme = t.nation.select(F.col("n_nationkey").cast("bigint").alias("tile_id"), (32600 + F.col("n_nationkey") % 60 + 1).cast("bigint").alias("epsg"))
    return joins.unique_lookup(t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("bigint").alias("tile_id")), scheme, "tile_id")


@query(
    "j15_translated_boxes",
    f"""SELECT s.source_key, t.tile_id, CAST((t.ymax - least(s.ymax, t.ymax)) * 4 AS BIGINT) AS i0, CAST((t.ymax - greatest(s.ymin, t.ymin)) * 4 AS BIGINT) AS i1,
CAST((greatest(s.xmin, t.xmin) - t.xmin) * 4 AS BIGINT) AS j0, CAST((least(s.xmax, t.xmax) - t.xmin) * 4 AS BIGINT) AS j1 FROM fx_sources s JOIN fx_tiles t ON {_MEETS}""",
)
def _(t: Tables) -> DataFrame:
    return joins.translate_boxes(t.sources, t.tiles, 15, 0.25).select("l.source_key", "r.tile_id", "i0", "i1", "j0", "j1")


@query("j16_unprocessed", "SELECT p_partkey AS key FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)")
def _(t: Tables) -> DataFrame:
    return joins.unprocessed(t.part.select(F.col("p_partkey").alias("key")), t.lineitem.where("l_quantity >= 49").select(F.col("l_partkey").alias("key")), ["key"])


@query("j17_companions", "SELECT a.key AS key_a, b.key AS key_b, a.tag FROM fx_files a JOIN fx_files b ON a.tag = b.tag")
def _(t: Tables) -> DataFrame:
    b = t.files.select(F.col("key").alias("key_b"), F.col("tag").alias("file_b"))
    out = joins.by_tag(t.files.select(F.col("key").alias("key_a"), F.col("tag").alias("file_a")), b, "file_a", "file_b", r"[NS]\d{2}[EW]\d{3}", ["key_b"])
    return out.select("key_a", "key_b", "tag")


@query("j18_volume_corners", "SELECT p_partkey AS key, CAST(46 - p_partkey % 26 AS BIGINT) AS lat, CAST(p_size - 106 AS BIGINT) AS lon FROM part")
def _(t: Tables) -> DataFrame:
    letter = F.char((F.col("p_partkey") % 26 + 65).cast("int"))
    return t.part.select(F.col("p_partkey").alias("key"), joins.volume_corner(letter, F.col("p_size")).alias("v")).select("key", "v.lat", "v.lon")


@query(
    "w3_name_weights",
    f"""SELECT key, {q6("CASE substr(coast_name, 4, 1) WHEN 'C' THEN 3e-2 WHEN 'F' THEN 4e-2 WHEN 'H' THEN 5e-2 WHEN 'J' THEN 6e-2 ELSE 0e0 END")} AS size_weight,
{q6("CASE WHEN filename LIKE 'ncei13%' THEN 13e-2 ELSE 1e-1 END")} AS resolution_weight, {q6("CAST(regexp_extract(filename, '_([0-9]{4})v[0-9]', 1) AS DOUBLE) / 1e4")} AS year_weight FROM fx_files""",
)
def _(t: Tables) -> DataFrame:
    f = F.col("filename")
    return t.files.select(
        "key", r6(ranking.size_weight(F.col("coast_name"))).alias("size_weight"), r6(ranking.resolution_weight(f)).alias("resolution_weight"), r6(ranking.year_weight(f)).alias("year_weight")
    )


@query("w5_latest_versions", "SELECT tile, key FROM (SELECT substr(coast_name, 1, 8) AS tile, key, row_number() OVER (PARTITION BY substr(coast_name, 1, 8) ORDER BY regexp_extract(coast_name, '_([0-9]{8})', 1) DESC, key) AS o FROM fx_files) s WHERE o = 1")
def _(t: Tables) -> DataFrame:
    rows = t.files.select(F.substring("coast_name", 1, 8).alias("tile"), "key", F.regexp_extract("coast_name", r"_(\d{8})", 1).alias("day"))
    return ranking.latest(rows, ["tile"], [F.col("day").desc(), F.col("key")]).select("tile", "key")


@query(
    "w6_latest_and_finest",
    """SELECT corner, key FROM (SELECT regexp_extract(filename, '_(n.*_w[0-9]{3}x[0-9]+)_', 1) AS corner, key,
  row_number() OVER (PARTITION BY regexp_extract(filename, '_(n.*_w[0-9]{3}x[0-9]+)_', 1) ORDER BY regexp_extract(filename, '_([0-9]{4})v', 1) DESC, filename LIKE 'ncei13%' DESC, key) AS o FROM fx_files WHERE filename NOT LIKE '%unk%') s WHERE o = 1""",
)
def _(t: Tables) -> DataFrame:
    denied = t.files.where("filename like '%unk%'").select("key")
    f = F.col("filename")
    rows = joins.unprocessed(t.files, denied, ["key"]).select(
        F.regexp_extract(f, r"_(n.*_w\d{3}x\d+)_", 1).alias("corner"), "key", F.regexp_extract(f, r"_(\d{4})v", 1).alias("year"), f.like("ncei13%").alias("fine")
    )
    return ranking.latest(rows, ["corner"], [F.col("year").desc(), F.col("fine").desc(), F.col("key")]).select("corner", "key")


@query("w7_latitude_order", "SELECT key, row_number() OVER (ORDER BY abs(y), y DESC, x, key) AS place FROM (SELECT key, " + _TAG + " FROM fx_files) s")
def _(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    rows = t.files.select("key", names.tag_corner(F.col("tag")).alias("c")).select("key", "c.y", "c.x")
    # places count within each latitude; offsets come from the counts of latitudes, of which there are 180
    band = [F.abs(F.col("y")), F.col("y").desc()]
    sizes = rows.groupBy("y").agg(F.count("*").alias("n"))
    before = sizes.withColumn("base", F.coalesce(F.sum("n").over(Window.orderBy(*band).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("y", "base")
    inside = F.row_number().over(Window.partitionBy("y").orderBy("x", "key"))
    return rows.withColumn("r", inside).join(F.broadcast(before), "y").select("key", (F.col("base") + F.col("r")).cast("bigint").alias("place"))


@query("w8_unfinished_sample", "SELECT CAST(n_nationkey AS BIGINT) AS tile, least(count(c_custkey), 10) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1 HAVING count(c_custkey) > 0")
def _(t: Tables) -> DataFrame:
    kept = ranking.hash_top(t.customer, ["c_nationkey"], ["c_custkey"], 10)
    return kept.groupBy(F.col("c_nationkey").alias("tile")).agg(F.count("*").alias("n"))


@query("u1_concatenated", "SELECT kind, count(*) AS n FROM (SELECT 'a' AS kind FROM fx_photons WHERE class_code = 1 UNION ALL SELECT 'b' FROM fx_photons WHERE class_code > 0) s GROUP BY 1")
def _(t: Tables) -> DataFrame:
    a, b = t.photons.where("class_code = 1").select(F.lit("a").alias("kind")), t.photons.where("class_code > 0").select(F.lit("b").alias("kind"))
    return a.unionByName(b).groupBy("kind").agg(F.count("*").alias("n"))


@query("u2_distinct_links", "SELECT DISTINCT regexp_replace(url, '[?#].*', '') AS link FROM pages")
def _(t: Tables) -> DataFrame:
    return t.pages.select(F.regexp_replace("url", r"[?#].*", "").alias("link")).distinct().orderBy("link")


@query("u5_not_converted", "SELECT replace(filename, '.tif', '_egm.tif') AS filename FROM fx_files EXCEPT ALL SELECT replace(filename, '.tif', '_egm.tif') FROM fx_files WHERE size % 2 = 0")
def _(t: Tables) -> DataFrame:
    name = F.replace(F.col("filename"), F.lit(".tif"), F.lit("_egm.tif")).alias("filename")
    return t.files.select(name).exceptAll(t.files.where("size % 2 = 0").select(name))


@query("u6_first_seen", "SELECT filename, min(key) AS key FROM fx_files GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return ranking.first_seen(t.files.select("filename", "key"), "filename", ["key"]).select("filename", "key")


@query(
    "src13_registry_update",
    "SELECT r.dset_name, r.id_number, coalesce(u.ranking_score, r.ranking_score) AS ranking_score, r.region, r.is_active FROM fx_source_registry r LEFT JOIN (SELECT s_name AS dset_name, s_suppkey + 50 AS ranking_score FROM supplier WHERE s_nationkey % 5 = 1) u ON u.dset_name = r.dset_name",
)
def _(t: Tables) -> DataFrame:
    new = t.supplier.where("s_nationkey % 5 = 1").select(F.col("s_name").alias("dset_name"), (F.col("s_suppkey") + 50).alias("ranking_score"))
    path = new_folder(t.spark, "registry")
    t.source_registry.write.parquet(path)
    writers.replace_table(readers.updated_registry(t.spark.read.parquet(path), new), path)
    return t.spark.read.parquet(path)


@query("src14_active_sources", "SELECT id_number, dset_name, ranking_score, region, is_active FROM fx_source_registry WHERE is_active")
def _(t: Tables) -> DataFrame:
    return readers.active_summary(t.source_registry)


@query(
    "src15_tile_index",
    "SELECT filename AS tile_id, CAST(xmin AS DOUBLE) AS xmin, CAST(xmin + 4 AS DOUBLE) AS xmax, CAST(ymax - 3 AS DOUBLE) AS ymin, CAST(ymax AS DOUBLE) AS ymax, 5e-1 AS xstep, 25e-2 AS ystep FROM fx_sources",
)
def _(t: Tables) -> DataFrame:
    return readers.tile_index(_grids(t)).select("tile_id", "xmin", "xmax", "ymin", "ymax", "xstep", "ystep")


def _grids(t: Tables) -> DataFrame:
    return t.sources.select(
        F.col("filename").alias("tile_id"), F.col("xmin").cast("double").alias("xleft"), F.col("ymax").cast("double").alias("ytop"), F.lit(0.5).alias("xres"), F.lit(-0.25).alias("yres"),
        F.lit(8).alias("xsize"), F.lit(12).alias("ysize"), F.when(F.col("source_key") % 2 == 0, 4326).otherwise(4269).alias("epsg"), "source_key",
    )


@query(
    "src16_outlines",
    "SELECT filename AS tile_id, CAST(xmin AS DOUBLE) AS xmin, CAST(xmin + 4 AS DOUBLE) AS xmax, CAST(ymax - 3 AS DOUBLE) AS ymin, CAST(ymax AS DOUBLE) AS ymax FROM fx_sources",
)
def _(t: Tables) -> DataFrame:
    return grid.corners(_grids(t)).select("tile_id", "xmin", "xmax", "ymin", "ymax")


@query(
    "src18_sub_rasters",
    """WITH g AS (SELECT filename AS tile_id, CAST(xmin AS DOUBLE) AS x, CAST(ymax AS DOUBLE) AS y, xmin + 1e0 AS bx0, xmin + 25e-1 AS bx1, ymax - 2e0 AS by0, ymax - 5e-1 AS by1 FROM fx_sources),
k AS (SELECT tile_id, x, y, greatest(0, floor((by1 - y) / -25e-2) - 1) AS i0, least(12, ceil((by0 - y) / -25e-2) + 1) AS i1, greatest(0, floor((bx0 - x) / 5e-1) - 1) AS j0, least(8, ceil((bx1 - x) / 5e-1) + 1) AS j1 FROM g)
SELECT tile_id, x + j0 * 5e-1 AS sub_xleft, y + i0 * -25e-2 AS sub_ytop, CAST((j1 - j0) * 2 AS BIGINT) AS sub_xsize, CAST((i1 - i0) * 2 AS BIGINT) AS sub_ysize FROM k""",
)
def _(t: Tables) -> DataFrame:
    g = _grids(t).withColumns({"bx0": F.col("xleft") + 1.0, "bx1": F.col("xleft") + 2.5, "by0": F.col("ytop") - 2.0, "by1": F.col("ytop") - 0.5})
    return grid.sub_raster(g, 2, 1).select("tile_id", "sub_xleft", "sub_ytop", F.col("sub_xsize").cast("bigint").alias("sub_xsize"), F.col("sub_ysize").cast("bigint").alias("sub_ysize"))


_BOX = "SELECT photon_id, l_partkey, l_suppkey FROM fx_photons WHERE longitude >= 3 AND longitude < 55e-1 AND latitude >= 42 AND latitude < 4425e-2"


@query("src3_photons_in_box", _BOX)
def _(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "tiles")
    counts = writers.write_photon_tiles(t.photons, path, 1.0, block=5)
    known = counts.select(F.col("tile_lon").alias("xmin"), F.col("tile_lat").alias("ymin")).withColumns({"xmax": F.col("xmin") + 1, "ymax": F.col("ymin") + 1, "is_populated": F.lit(True)})
    return readers.photons_in_box(t.spark.read.parquet(path), known, (3.0, 42.0, 5.5, 44.25), 1.0, 5).select("photon_id", "l_partkey", "l_suppkey")


@query("src3_clustered_box", _BOX)
def _(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "clustered")
    files = clustered.write_clustered(t.photons, path, files=32)
    return clustered.read_box(t.spark, path, files, (3.0, 42.0, 5.5, 44.25)).select("photon_id", "l_partkey", "l_suppkey")


@query("src7_beam_values", "SELECT 'g' || granule_id1 AS granule, beam, photon_id AS pos, h_geoid FROM fx_photons WHERE beam IN (0, 2, 4)")
def _(t: Tables) -> DataFrame:
    flat = t.photons.select(F.concat(F.lit("g"), F.col("granule_id1").cast("string")).alias("granule"), "beam", F.col("photon_id").alias("pos"), "h_geoid")
    return readers.beam_values(flat, [0, 2, 4], ["h_geoid"])


@query("src8_accumulated", "SELECT 'g' || granule_id1 AS granule, beam, photon_id AS pos, h_geoid FROM fx_photons")
def _(t: Tables) -> DataFrame:
    flat = t.photons.select(F.concat(F.lit("g"), F.col("granule_id1").cast("string")).alias("granule"), "beam", F.col("photon_id").alias("pos"), "h_geoid")
    return readers.accumulate(flat, "h_geoid")


@query(
    "snk1_photon_tiles",
    "SELECT floor(latitude) AS tile_lat, floor(longitude) AS tile_lon, count(*) AS numphotons, count(*) FILTER (WHERE class_code BETWEEN 2 AND 3) AS numphotons_canopy, count(*) FILTER (WHERE class_code = 1) AS numphotons_ground FROM fx_photons GROUP BY 1, 2",
)
def _(t: Tables) -> DataFrame:
    out = writers.write_photon_tiles(t.photons, new_folder(t.spark, "tiles"), 1.0, block=10)
    return out.select(F.col("tile_lat").cast("double").alias("tile_lat"), F.col("tile_lon").cast("double").alias("tile_lon"), "numphotons", "numphotons_canopy", "numphotons_ground")


@query(
    "snk4_tracks",
    "SELECT granule_id1, granule_id2, beam, count(*) AS n_points, 'LINESTRING (' || string_agg(longitude || ' ' || latitude, ', ' ORDER BY photon_id, l_partkey, l_suppkey, longitude, latitude) || ')' AS wkt FROM fx_photons WHERE longitude BETWEEN 1 AND 9 AND latitude BETWEEN 41 AND 49 GROUP BY 1, 2, 3 HAVING count(*) >= 2",
)
def _(t: Tables) -> DataFrame:
    return writers.tracks(t.photons, F.struct("photon_id", "l_partkey", "l_suppkey", "longitude", "latitude"), ("granule_id1", "granule_id2", "beam"), box=(1, 41, 9, 49))


def _stream(t: Tables, kind: str) -> DataFrame:
    """The events table as a file stream, with its times in UTC."""
    # a pattern that matches the one table
    rows = t.spark.readStream.schema(t.events.schema).parquet(f"{t.sf_dir}/events.parque[t]")
    return rows.withColumn("ts", F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp")).where(F.lit(True) if kind == "all" else F.col("event_type") == kind)


@query(
    "st1_matched_stream",
    "SELECT a.event_id AS event_id_a, b.event_id AS event_id_b, a.user_id AS key_a FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'click' AND b.event_type = 'purchase' AND b.ts >= a.ts - INTERVAL 1 HOUR AND b.ts <= a.ts + INTERVAL 1 HOUR",
)
def _(t: Tables) -> DataFrame:
    pairs = jobs.matched_stream(_stream(t, "click"), _stream(t, "purchase"), "user_id").select("event_id_a", "event_id_b", "key_a")
    out = new_folder(t.spark, "stream")
    query = pairs.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return t.spark.read.schema(pairs.schema).parquet(f"{out}/rows")


@query(
    "st1_once_only",
    # every file arrives twice; a pair comes out once
    "SELECT a.event_id AS event_id_a, b.event_id AS event_id_b, a.user_id AS key_a FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'click' AND b.event_type = 'purchase' AND b.ts >= a.ts - INTERVAL 1 HOUR AND b.ts <= a.ts + INTERVAL 1 HOUR",
)
def _(t: Tables) -> DataFrame:
    twice = lambda kind: _stream(t, kind).unionByName(_stream(t, kind))
    pairs = jobs.matched_stream(twice("click"), twice("purchase"), "user_id", once=["event_id"]).select("event_id_a", "event_id_b", "key_a")
    out = new_folder(t.spark, "stream")
    pairs.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema(pairs.schema).parquet(f"{out}/rows")


@query(
    "st2_catalogue_upsert",
    "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS o FROM events WHERE event_type = 'click') s WHERE o = 1",
)
def _(t: Tables) -> DataFrame:
    out = new_folder(t.spark, "upsert")
    # a catalogue with a row for each user, and summaries in five files, one a batch
    box = {"xmin": (F.col("user_id") % 360 - 180).cast("int"), "ymin": (F.col("user_id") % 180 - 90).cast("int")}
    rows = t.events.withColumns(box).select("user_id", "event_id", "event_type", "value", *box)
    rows.where("event_type = 'click'").repartition(5, "event_id").write.option("header", True).csv(f"{out}/spool")
    blank = rows.select("user_id", *box).distinct().select("user_id", F.lit(-1).cast("bigint").alias("event_id"), F.lit("").alias("event_type"), F.lit(0.0).alias("value"), *box)
    spool = jobs.spool(t.spark, f"{out}/spool", "user_id bigint, event_id bigint, event_type string, value double, xmin int, ymin int")
    jobs.upsert_stream(spool, f"{out}/table", f"{out}/state", ["user_id"], "event_id", blank, list(box)).awaitTermination()
    return jobs.latest(t.spark, f"{out}/table").where("event_id >= 0").drop(*box)


@query("st3_progress_upsert", "SELECT granule, max(csv_filename) AS csv_filename, max(photon_count) AS photon_count FROM (SELECT granule, csv_filename, photon_count, rank() OVER (PARTITION BY granule ORDER BY csv_filename DESC) AS o FROM fx_rejects) s WHERE o = 1 GROUP BY 1")
def _(t: Tables) -> DataFrame:
    old, new = t.rejects.where("csv_filename < 15"), t.rejects.where("csv_filename >= 15")
    return jobs.upsert(jobs.upsert(old, new, ["granule"], "csv_filename"), new, ["granule"], "csv_filename")


@query("st4_affected_tiles", "SELECT DISTINCT CAST(floor(longitude / 1e1) AS BIGINT) AS tile_id FROM fx_photons WHERE granule_id1 = 3 AND granule_id2 = 0 AND class_code = 4")
def _(t: Tables) -> DataFrame:
    rejected = t.photons.where("granule_id1 = 3 and granule_id2 = 0").select("granule_id1", "granule_id2").distinct()
    return jobs.affected_tiles(binned(t.photons).where("class_code = 4"), rejected)


@query(
    "st4_revalidated",
    "SELECT CAST(floor(longitude / 1e1) AS BIGINT) AS tile_id, count(*) AS n, sum(h_geoid) AS total FROM fx_photons WHERE NOT (granule_id1 = 3 AND granule_id2 = 0) GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    path, photons = new_folder(t.spark, "results"), binned(t.photons)
    validate = lambda rows: rows.groupBy("tile_id").agg(F.count("*").alias("n"), F.sum("h_geoid").alias("total"))
    validate(photons).write.partitionBy("tile_id").parquet(path)
    jobs.revalidate(path, photons, photons.where("granule_id1 = 3 and granule_id2 = 0").select("granule_id1", "granule_id2").distinct(), validate)
    return t.spark.read.parquet(path).select(F.col("tile_id").cast("bigint").alias("tile_id"), "n", "total")


@query(
    "st3_rebuilt_progress",
    "SELECT c_custkey AS box, count(DISTINCT o_orderkey % 50) AS numgranules, count(o_orderkey) > 0 AS is_done FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    boxes, granules = t.customer.select(F.col("c_custkey").alias("box")), t.orders.select(F.col("o_custkey").alias("box"), (F.col("o_orderkey") % 50).alias("granule"))
    return jobs.progress_table(boxes, granules, "box")


@query(
    "st5_backfill",
    "WITH p AS (SELECT CAST(floor(longitude / 1e1) AS BIGINT) AS tile_id, class_code FROM fx_photons) SELECT tile_id, count(*) AS numphotons, count(*) FILTER (WHERE class_code BETWEEN 2 AND 3) AS numphotons_canopy, count(*) FILTER (WHERE class_code = 1) AS numphotons_ground FROM p WHERE tile_id % 2 = 0 GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    counted = validation.tile_counts(binned(t.photons))
    return jobs.backfill(counted.select("tile_id", (F.col("tile_id") % 2 == 1).alias("is_populated")), counted)


@query(
    "st6_running_statistics",
    # the days that a watermark of one day has passed
    f"SELECT event_type, epoch(date_trunc('day', ts))::BIGINT AS day, count(*) AS n, {q6('avg(value)')} AS mean FROM events WHERE date_trunc('day', ts) + INTERVAL 2 DAY <= (SELECT max(ts) FROM events) GROUP BY 1, 2",
)
def _(t: Tables) -> DataFrame:
    rows = jobs.running_statistics(_stream(t, "all"), ["event_type"], "value")
    out = new_folder(t.spark, "statistics")
    rows.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema(rows.schema).parquet(f"{out}/rows").select("event_type", F.unix_seconds("window.start").alias("day"), "n", r6("mean").alias("mean"))


@query(
    "g3_occupied_tiles",
    "SELECT DISTINCT CASE WHEN y < 0 THEN 'S' ELSE 'N' END || lpad(CAST(abs(y) AS STRING), 2, '0') || CASE WHEN x < 0 THEN 'W' ELSE 'E' END || lpad(CAST(abs(x) AS STRING), 3, '0') AS tile FROM (SELECT CAST(floor(latitude / 15) * 15 AS BIGINT) AS y, CAST(floor(longitude / 15) * 15 AS BIGINT) AS x FROM fx_photons) s WHERE x < 180",
)
def _(t: Tables) -> DataFrame:
    at = lambda c: F.floor(F.col(c) / 15.0) * 15
    tag = names.tile_tag(at("latitude"), at("longitude"))
    return grid.tile_grid(t.spark, 15).join(t.photons.where("longitude < 180").select(tag.alias("tile")), "tile", "left_semi").select("tile")


@query(
    "g4_quarter_boxes",
    "SELECT source_key, xmin + c / 4e0 AS sub_xmin, ymin - 92 + r / 4e0 AS sub_ymin FROM fx_sources, (SELECT unnest(range(0, 4)) AS c) a, (SELECT unnest(range(0, 4)) AS r) b WHERE ymin - 92 + r / 4e0 >= -90",
)
def _(t: Tables) -> DataFrame:
    boxes = t.sources.select("source_key", "xmin", (F.col("ymin") - 92).alias("ymin"))
    return grid.split_boxes(boxes, 4).select("source_key", "sub_xmin", "sub_ymin")


@query("g5_outward_boxes", "SELECT tile_id, xmin, ymin - 30 AS ymin, abs(ymin - 30 + 5e-1) AS place FROM fx_tiles")
def _(t: Tables) -> DataFrame:
    return grid.outward(t.tiles.select("tile_id", "xmin", (F.col("ymin") - 30).alias("ymin")))


@query("g6_sub_tiles", "SELECT tile_id, CAST(floor(i / 5e0) AS BIGINT) AS r, CAST(floor(j / 5e0) AS BIGINT) AS c, count(*) AS n FROM fx_cells GROUP BY 1, 2, 3")
def _(t: Tables) -> DataFrame:
    return grid.sub_tiles(t.cells, 5).groupBy("tile_id", "r", "c").agg(F.count("*").alias("n"))


@query("f11_quality_segments", "SELECT segment_id FROM fx_segments WHERE beam <> 3 AND segment_id % 2 = 0 AND segment_id % 3 <> 1")
def _(t: Tables) -> DataFrame:
    s = F.col("segment_id")
    rows = t.segments.withColumns({"passed": F.col("beam") != 3, "surf": F.array(F.when(s % 2 == 0, 1).otherwise(0), F.lit(0), F.when(s % 3 == 1, 1).otherwise(0), F.lit(0), F.lit(0))})
    return filters.quality_segments(rows, "passed", "surf", True).select("segment_id")


@query("geo8_inside_outline", f"SELECT DISTINCT s.source_key FROM fx_sources s JOIN fx_tiles t ON {_MEETS} WHERE t.xmin >= 15 AND t.ymax <= 60")
def _(t: Tables) -> DataFrame:
    return overlap_join(t.sources, t.tiles.where("xmin >= 15 and ymax <= 60"), 15).select("l.source_key").distinct()


@query("geo7_border_actions", "SELECT c.tile_id, c.i, c.j FROM fx_cells c WHERE c.tile_id % 5 <> 1 AND (c.tile_id % 5 <> 2 OR (c.i + 5e-1 >= 4 AND c.i + 5e-1 < 15 AND c.j + 5e-1 >= 3 AND c.j + 5e-1 < 12))")
def _(t: Tables) -> DataFrame:
    from relievo.functions import geometry

    actions = t.cells.select("tile_id").distinct().withColumn("action", F.when(F.col("tile_id") % 5 == 1, "omit").when(F.col("tile_id") % 5 == 2, "mask"))
    rows = t.cells.join(actions.where("action = 'omit'"), "tile_id", "left_anti").join(actions.select("tile_id", "action"), "tile_id")
    ring = geometry.box_ring(*(F.lit(float(v)) for v in (3, 4, 12, 15)))
    inside = geometry.contains(ring, F.col("j") + 0.5, F.col("i") + 0.5)
    return rows.where((F.coalesce("action", F.lit("")) != "mask") | inside).select("tile_id", "i", "j")


@query("x1_registry_weights", "SELECT dset_name, CASE WHEN region = 1 THEN ranking_score + 5e-1 ELSE CAST(ranking_score AS DOUBLE) END AS weight FROM fx_source_registry WHERE is_active AND dset_name NOT LIKE '%2'")
def _(t: Tables) -> DataFrame:
    rows = t.source_registry.where(~F.col("dset_name").like("%2")).withColumn("region", F.col("region").cast("string"))
    return collections.source_weights(rows, {"1": lambda w: w + 0.5}, "region").select("dset_name", "weight")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validation of every cell, summed up."""
    from relievo.queries.photons import a4

    return a4(Tables(spark, sf_dir))


@query(
    "x1_entry_lists",
    f"""SELECT tile_id, filename, dset_name, CASE WHEN dset_name IN (SELECT dset_name FROM fx_registry WHERE id_number = 1) THEN weight + CAST(right(filename, 1) AS BIGINT) / 8e0 ELSE CAST(weight AS DOUBLE) END AS weight
FROM ({_DATALIST}) d WHERE NOT (dset_name IN (SELECT dset_name FROM fx_registry WHERE id_number = 2) AND right(filename, 1) = '3')""",
)
def _(t: Tables) -> DataFrame:
    names_of = dict(tuple(r) for r in t.registry.where("id_number < 3").select("id_number", "dset_name").collect())
    finer = lambda e: e.withColumn("weight", F.col("weight") + F.expr("cast(right(filename, 1) as bigint)") / 8.0)
    fewer = lambda e: e.where("right(filename, 1) <> '3'")
    excluded = (F.col("l.ymin") < 15) & F.col("id").isin([r["id_number"] for r in t.registry.where("region = 2").collect()])
    return collections.entry_lists(t.tiles, t.sources, t.registry, 15, {names_of[1]: finer, names_of[2]: fewer}, excluded)
