"""Readers (SRC1-SRC15): results, photon tiles, listings, grids, registries, attribute tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relievo.operators.filters import reliable
from relievo.plans.ranges import around_between, edge, pruned
from relievo.plans.storage import exists
from relievo.sources.schemas import ATTRIBUTES, PHOTON


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """SRC1: a table by its extension: parquet, csv, txt, json or orc."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    reader = spark.read if schema is None else spark.read.schema(schema)
    if kind in ("parquet", "orc", "json"):
        return reader.format(kind).load(path)
    if kind in ("csv", "txt"):
        return reader.option("header", True).option("inferSchema", schema is None).csv(path)
    raise ValueError(f"no reader for {path}")


def read_photon_tiles(spark: SparkSession, path: str, lat: float | None = None, lon: float | None = None) -> DataFrame | None:
    """SRC2: photon tiles, of one tile where given; none where there are no such tiles. The keys are partition columns."""
    if not exists(spark, path):
        return None
    rows = spark.read.parquet(path)
    if lat is None:
        return rows
    rows = rows.where((F.col("tile_lat") == lat) & (F.col("tile_lon") == lon))
    return None if rows.isEmpty() else rows


def read_feather(spark: SparkSession, path: str, schema: str = PHOTON) -> DataFrame:
    """SRC2: Feather files, by the names of their columns; a task reads one file at a time, as Arrow batches of a bounded number of rows."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(spark.createDataFrame([], schema).schema)

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import feather

        for batch in batches:
            for content in batch.column("content"):
                table = feather.read_table(pa.BufferReader(content.as_buffer()), columns=kinds.names)
                yield from table.select(kinds.names).cast(kinds).to_batches(max_chunksize=1 << 17)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(tables, schema)


def photons_in_box(tiles: DataFrame, catalogue: DataFrame, box: Sequence[float], tile: float = 0.25, block: int = 1) -> DataFrame:
    """SRC3: photons of a box from the tiles that the catalogue calls populated.

    The tile bounds reach the scan as partition filters, with those of the folders where
    a folder holds ``block`` by ``block`` tiles; the box itself is exact.
    """
    xmin, ymin, xmax, ymax = box
    hit = catalogue.where("is_populated").where((F.col("xmin") < xmax) & (F.col("xmax") > xmin) & (F.col("ymin") < ymax) & (F.col("ymax") > ymin))
    hit = hit.select(F.col("xmin").alias("tile_lon"), F.col("ymin").alias("tile_lat"))
    rows = pruned(tiles, "longitude", "latitude", box, tile)
    if block > 1:
        wide = tile * block
        west, south, east, north = (edge(v, tile) for v in box)  # a block is that of a tile's edge
        rows = rows.where(around_between(F.col("block_lon"), west, east, wide) & F.col("block_lat").between(edge(south, wide), edge(north, wide)))
    return rows.join(hit, ["tile_lon", "tile_lat"], "left_semi")


def empty_photons(spark: SparkSession) -> DataFrame:
    """SRC4."""
    return spark.createDataFrame([], PHOTON)


def read_results(spark: SparkSession, paths: Sequence[str], with_filename: bool = False) -> DataFrame:
    """SRC5: result tables of many files together, reliable cells only."""
    rows = spark.read.parquet(*paths)
    if with_filename:
        rows = rows.select("*", F.col("_metadata.file_name").alias("filename"))
    return reliable(rows)


def listed_values(listed: DataFrame, table: DataFrame, columns: Sequence[str], below: str) -> DataFrame:
    """SRC6: a listing with the distinct ``columns`` of each listed file of ``table``.

    ``below`` is a pattern for the part of a path by which the two are matched (the forms of a path's
    beginning differ). So a listing can tell what files hold without a folder for each value.
    """
    at = lambda c: F.regexp_extract(c, below, 0)
    held = table.select(at(F.col("_metadata.file_path")).alias("__at"), *columns).distinct()
    return listed.withColumn("__at", at(F.col("path"))).join(held, "__at").drop("__at")


def list_files(spark: SparkSession, folder: str, pattern: str | None = None, depth: int | None = None) -> DataFrame:
    """SRC6: paths, sizes and times below a folder, by name pattern and depth, ordered; contents are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length", "modificationTime")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    if pattern is not None:
        rows = rows.where(name.rlike(pattern))
    if depth is not None:
        base = folder.split("://", 1)[-1].rstrip("/").lstrip("/")
        below = F.regexp_replace(F.regexp_replace("path", r"^[a-z]+:/*", ""), f"^{base}/", "")
        rows = rows.where(F.size(F.split(below, "/")) - 1 <= depth)
    return rows.orderBy("path")


def beam_values(table: DataFrame, beams: Sequence[str] | None, columns: Sequence[str]) -> DataFrame:
    """SRC7: columns of a flattened granule table for some beams, in beam and place order."""
    rows = table if beams is None else table.where(F.col("beam").isin(list(beams)))
    return rows.select("granule", "beam", "pos", *columns).orderBy("granule", "beam", "pos")


def accumulate(table: DataFrame, column: str, most_granules: int | None = None) -> DataFrame:
    """SRC8: one variable over all granules, or the first so many by name."""
    if most_granules is None:
        return table.select("granule", "beam", "pos", column)
    first = table.select("granule").distinct().orderBy("granule").limit(most_granules)
    return table.join(first, "granule", "left_semi").select("granule", "beam", "pos", column)


def attribute_table(spark: SparkSession, path: str) -> DataFrame:
    """SRC10: raster attribute tables in XML, one row element for each value."""
    rows = spark.read.format("xml").option("rowTag", "Row").schema("F array<string>").load(path)
    kinds = [c.split(" ") for c in ATTRIBUTES.split(", ")]
    return rows.select(*(F.get("F", i).try_cast(kind).alias(name) for i, (name, kind) in enumerate(kinds)))


def ascii_grids(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC11: ESRI ASCII grids as a grid table and a cell table, by file path; missing values have no row."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("tile_id"), F.trim("value").alias("line"))
    head = lines.where(F.col("line").rlike(r"^(?i)(ncols|nrows|xll|yll|cellsize|nodata)"))
    pairs = head.select("tile_id", F.lower(F.split("line", r"\s+")[0]).alias("k"), F.split("line", r"\s+")[1].cast("double").alias("v"))
    grid = pairs.groupBy("tile_id").pivot("k", ["ncols", "nrows", "xllcorner", "yllcorner", "cellsize", "nodata_value"]).agg(F.first("v"))
    # whole files keep their row order; one row is a raster row
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("tile_id"), F.posexplode(F.split("value", r"\r?\n")).alias("n", "line"))
    body = whole.where(F.trim("line").rlike(r"^[-+0-9.]"))
    first = body.groupBy("tile_id").agg(F.min("n").alias("n0"))
    cells = body.join(first, "tile_id").select("tile_id", (F.col("n") - F.col("n0")).alias("i"), F.posexplode(F.split(F.trim("line"), r"\s+")).alias("j", "v"))
    cells = cells.withColumn("value", F.col("v").try_cast("double")).join(grid.select("tile_id", "nodata_value"), "tile_id")
    return grid, cells.where("value is not null and not value <=> nodata_value").select("tile_id", "i", "j", "value")


#: Registry columns and the keys of the configuration files that give them.
REGISTRY_KEYS = {
    "dset_name": "dataset_name", "ranking_score": "default_ranking_score", "id_number": "dataset_id_number", "vdatum_name": "dataset_vdatum_name",
    "vdatum_epsg": "dataset_vdatum_epsg", "is_active": "is_active",
}


def registry(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """SRC12: the source registry from its configuration files; values are literals, quoted or up to a comment, and never evaluated.

    A file is one configuration, or, with ``separator``, many that each end with it
    (:func:`relievo.sources.writers.write_registry`), so their number does not make the number of files.
    """
    rows = spark.read.text(path, wholetext=True) if separator is None else spark.read.text(path, lineSep=separator)
    part = lambda k, n: F.regexp_extract("value", rf"(?m)^[ \t]*{k}[ \t]*=[ \t]*(?:\"([^\"\r\n]*)\"|'([^'\r\n]*)'|([^#\r\n]*))", n)
    value = lambda k: F.nullif(F.trim(F.concat(part(k, 1), part(k, 2), part(k, 3))), F.lit(""))
    out = rows.select(*(value(k).alias(n) for n, k in REGISTRY_KEYS.items()), F.col("_metadata.file_name").alias("configfile"))
    return out.withColumns({"ranking_score": F.expr("try_cast(ranking_score as double)"), "id_number": F.expr("try_cast(id_number as int)"), "vdatum_epsg": F.expr("try_cast(vdatum_epsg as int)"), "is_active": F.lower("is_active") == "true"})


def updated_registry(old: DataFrame, new: DataFrame, key: str = "dset_name") -> DataFrame:
    """SRC13: the registry with new values where given; the old version stays wherever it was written."""
    columns = [c for c in old.columns if c != key]
    both = old.alias("o").join(new.alias("n"), key, "left")
    return both.select(key, *(F.coalesce(f"n.{c}", f"o.{c}").alias(c) if c in new.columns else F.col(f"o.{c}") for c in columns))


def active_summary(rows: DataFrame) -> DataFrame:
    """SRC14: active sources by rank."""
    return rows.where("is_active").orderBy("ranking_score", "id_number")


def tile_index(grids: DataFrame) -> DataFrame:
    """SRC15: bounding boxes of rasters; several reference systems raise (NAD83 counts as WGS 84)."""
    from relievo.operators.grid import corners

    code = F.when(F.col("epsg") == 4269, 4326).otherwise(F.col("epsg"))
    one = grids.agg(F.count_distinct(code).alias("n"))
    ok = F.when(F.col("n") <= 1, F.col("tile_id")).otherwise(F.raise_error(F.lit("rasters have several reference systems")).cast("string"))
    return corners(grids).crossJoin(F.broadcast(one)).withColumn("tile_id", ok).drop("n")
