"""Queries that write tables in an exchange format and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relievo.operators import collections, grid
from relievo.plans.storage import new_folder
from relievo.queries.catalogue import _grids
from relievo.queries.registry import Tables, q6, query, r6
from relievo.sources import readers, writers


@query("src1_snk2_csv_results", "SELECT tile_id, i, j, value FROM fx_cells")
def _(t: Tables) -> DataFrame:
    path = f"{new_folder(t.spark, 'results')}.csv"
    writers.write_results(t.cells.select("tile_id", "i", "j", "value"), path, "csv")
    return readers.read_table(t.spark, path, "tile_id bigint, i bigint, j bigint, value double")


@query("src2_one_photon_tile", "SELECT photon_id, l_partkey, l_suppkey FROM fx_photons WHERE floor(latitude) = 43 AND floor(longitude) = 4")
def _(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "tiles")
    writers.write_photon_tiles(t.photons, path, 1.0, block=10)
    found = readers.read_photon_tiles(t.spark, path, 43, 4)
    return (t.photons.limit(0) if found is None else found).select("photon_id", "l_partkey", "l_suppkey")


@query("src4_tiles_or_none", "SELECT granule_id1, granule_id2, longitude, latitude, dist_x FROM fx_photons WHERE floor(latitude) = 43 AND floor(longitude) IN (4, 5)")
def _(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "tiles")
    writers.write_photon_tiles(t.photons, path, 1.0, block=10)
    out = readers.empty_photons(t.spark)
    for lat, lon in ((43, 4), (-60, 4), (43, 5)):  # one of them is not there
        found = readers.read_photon_tiles(t.spark, path, lat, lon)
        out = out if found is None else out.unionByName(found, allowMissingColumns=True)
    return out.select("granule_id1", "granule_id2", "longitude", "latitude", "dist_x")


@query("src5_reliable_results", "SELECT tile_id, i, j, value AS diff_mean FROM fx_cells WHERE size > 3 AND value <> 120")
def _(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "results")
    rows = t.cells.select("tile_id", "i", "j", F.col("size").alias("n_trim"), F.when(F.col("value") == 120, -99999.0).otherwise(F.col("value")).alias("diff_mean"))
    for part in (0, 1):
        writers.write_results(rows.where(F.col("tile_id") % 2 == part), f"{path}/{part}")
    return readers.read_results(t.spark, [f"{path}/0", f"{path}/1"], True).select("tile_id", "i", "j", "diff_mean")


@query("src6_listed_files", "SELECT 'tile_lat=' || CAST(floor(latitude) AS INT) || '.0' AS folder, count(DISTINCT floor(longitude)) AS n_tiles FROM fx_photons GROUP BY 1")
def _(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "tiles")
    key = lambda c: F.floor(c).cast("double")
    writers.convert(t.photons.select("photon_id", key("latitude").alias("tile_lat"), key("longitude").alias("tile_lon")), f"{path}/flat")
    rows = t.spark.read.parquet(f"{path}/flat").repartitionByRange("tile_lat", "tile_lon").sortWithinPartitions("tile_lat", "tile_lon")
    rows.write.partitionBy("tile_lat").parquet(f"{path}/tiles")
    listed = readers.list_files(t.spark, f"{path}/tiles", r"\.parquet$")
    tiles = readers.listed_values(listed, t.spark.read.parquet(f"{path}/tiles"), ["tile_lon"], r"tile_lat=[^/]+/[^/]+$")
    return tiles.groupBy(F.regexp_extract("path", r"(tile_lat=[^/]+)", 1).alias("folder")).agg(F.count_distinct("tile_lon").alias("n_tiles"))


@query("src10_attribute_tables", "SELECT CAST(p_partkey AS BIGINT) AS value, CAST(p_size AS BIGINT) AS count, p_brand AS institution, CAST(p_size AS DOUBLE) / 4e0 AS resolution FROM part")
def _(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "xml")
    fields = F.array(*(F.col(c).cast("string") for c in ("p_partkey", "p_size", "p_brand")), (F.col("p_size") / 4.0).cast("string")).alias("F")
    t.part.select(fields).write.format("xml").option("rowTag", "Row").option("rootTag", "Table").save(path)
    return readers.attribute_table(t.spark, path)


@query("src11_ascii_grids", "SELECT tile_id, i, j, value FROM fx_cells WHERE size % 3 <> 0")
def _(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "asc")
    grids = t.cells.select("tile_id").distinct().withColumns({"xsize": F.lit(20), "ysize": F.lit(20)})
    full = writers.dense(t.cells.where("size % 3 <> 0"), grids)
    writers.write_ascii(full, grids.withColumns({"xleft": F.col("tile_id") * 10.0, "ybottom": F.lit(40.0), "cell": F.lit(0.5)}), path)
    _, cells = readers.ascii_grids(t.spark, f"{path}/*/*.txt")
    number = F.regexp_extract("tile_id", r"tile=(\d+)", 1).cast("bigint")
    return cells.withColumn("tile_id", number).select("tile_id", "i", "j", "value")


@query("src12_registry_files", "SELECT dset_name, CAST(ranking_score AS DOUBLE) AS ranking_score, id_number, is_active FROM fx_source_registry")
def _(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "ini")
    line = lambda k, c: F.concat(F.lit(f"{k} = "), F.col(c).cast("string"), F.lit("\n"))
    text = F.concat(F.lit('dataset_name = "'), F.col("dset_name"), F.lit('"  # a name\n'), line("default_ranking_score", "ranking_score"), line("dataset_id_number", "id_number"), line("is_active", "is_active"))
    writers.write_registry(t.source_registry.select(text.alias("value")), path)
    return readers.registry(t.spark, f"{path}/*.txt", writers.RECORD).select("dset_name", "ranking_score", "id_number", "is_active")


@query("src17_bounds_and_steps", "SELECT count(*) AS n, min(CAST(xmin AS DOUBLE)) AS xmin, max(xmin + 4e0) AS xmax, 5e-1 AS xstep, 25e-2 AS ystep FROM fx_sources")
def _(t: Tables) -> DataFrame:
    return grid.corners(_grids(t)).agg(F.count("*").alias("n"), F.min("xmin").alias("xmin"), F.max("xmax").alias("xmax"), F.max("xstep").alias("xstep"), F.max("ystep").alias("ystep"))


@query("snk5_converted", f"SELECT tile_id, count(*) AS n, {q6('sum(value)')} AS total FROM fx_cells GROUP BY 1")
def _(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "zstd")
    writers.convert(t.cells, path)
    return t.spark.read.parquet(path).groupBy("tile_id").agg(F.count("*").alias("n"), r6(F.sum("value")).alias("total"))


@query("x2_active_variants", "SELECT id_number, dset_name FROM fx_source_registry WHERE is_active AND NOT (region = 2 AND id_number % 2 = 0)")
def _(t: Tables) -> DataFrame:
    # the surface variants step back while beds are asked for
    surface = (F.col("region") == 2) & (F.col("id_number") % 2 == 0)
    return collections.active_variants(t.source_registry, True, surface, F.lit(False)).select("id_number", "dset_name")


@query("x4_projected_photons", "SELECT photon_id, l_partkey, l_suppkey FROM fx_photons WHERE longitude * 2 + 1 >= 5 AND longitude * 2 + 1 < 15 AND latitude - 40 >= 1 AND latitude - 40 < 6")
def _(t: Tables) -> DataFrame:
    return collections.in_converted_box(t.photons, "longitude", "latitude", (5, 1, 15, 6), lambda x, y: (x * 2 + 1, y - 40)).select("photon_id", "l_partkey", "l_suppkey")


@query("x3_missing_outputs", "SELECT p_partkey AS key, p_size * 2 AS doubled FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)")
def _(t: Tables) -> DataFrame:
    done = t.lineitem.where("l_quantity >= 49").select(F.col("l_partkey").alias("key"))
    tasks = t.part.select(F.col("p_partkey").alias("key"), F.col("p_size").cast("int").alias("size"))
    return collections.map_missing(tasks, done, ["key"], lambda rows: rows.assign(doubled=rows["size"] * 2)[["key", "doubled"]], "key bigint, doubled int")
