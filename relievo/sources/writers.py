"""Writers (SNK1-SNK7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relievo.operators.filters import in_box
from relievo.operators.validation import tile_counts
from relievo.plans.ranges import around
from relievo.plans.storage import rename


def write_photon_tiles(photons: DataFrame, path: str, tile: float = 0.25, block: int = 1) -> DataFrame:
    """SNK1: photons by tile, sorted for skipping inside files; returns the counts of each tile as it lies at ``path`` then.

    A folder holds one tile, or, where tiles are small, ``block`` by ``block`` of
    them; the tile is then a sorted column, and row groups of other tiles are
    skipped. Blocks are counted around the globe, so their number is bounded; longitudes a whole
    turn apart share a folder and keep their own tiles. A rewrite replaces whole folders. Rows are dealt by range of folder, tile and place, so
    a dense tile is several tasks' files. The counts read what was
    written, of two columns. For one table without folders see :mod:`relievo.sources.clustered`.
    """
    key = lambda c: F.floor(F.col(c) / tile) * tile
    rows = photons.withColumns({"tile_lat": key("latitude"), "tile_lon": key("longitude")})
    folder = ["tile_lat", "tile_lon"]
    if block > 1:
        folder = ["block_lat", "block_lon"]
        wide = tile * block
        rows = rows.withColumns({"block_lat": F.floor(F.col("tile_lat") / wide) * wide, "block_lon": around(F.col("tile_lon"), wide)})
    order = [*dict.fromkeys([*folder, "tile_lat", "tile_lon", "latitude", "longitude"])]
    out = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    out.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy(*folder).parquet(path)
    written = photons.sparkSession.read.parquet(path).withColumn("tile_id", F.struct(*(F.col(c).cast("double").alias(c) for c in ("tile_lat", "tile_lon"))))
    return tile_counts(written).select("tile_id.*", "numphotons", "numphotons_canopy", "numphotons_ground")


def write_results(results: DataFrame, path: str, kind: str = "parquet") -> None:
    """SNK2."""
    writer = results.write.mode("overwrite")
    writer.option("header", True).csv(path) if kind == "csv" else writer.parquet(path)


def dense(cells: DataFrame, grids: DataFrame, value: str = "value", empty: float = -99999.0) -> DataFrame:
    """SNK3: every cell of the grids, with the sentinel where there is no value."""
    frame = grids.select("tile_id", F.explode(F.expr("sequence(0, cast(ysize as int) - 1)")).alias("i"), "xsize")
    frame = frame.select("tile_id", "i", F.explode(F.expr("sequence(0, cast(xsize as int) - 1)")).alias("j"))
    return frame.join(cells.select("tile_id", "i", "j", value), ["tile_id", "i", "j"], "left").withColumn(value, F.coalesce(value, F.lit(empty)))


def grid_lines(full: DataFrame, value: str = "value") -> DataFrame:
    """SNK3: the text rows of an ASCII grid, one for each raster row."""
    row = F.transform(F.array_sort(F.collect_list(F.struct("j", F.col(value).alias("v")))), lambda s: s["v"].cast("string"))
    return full.groupBy("tile_id", "i").agg(F.array_join(row, " ").alias("line"))


def write_ascii(full: DataFrame, grids: DataFrame, path: str, empty: float = -99999.0) -> None:
    """SNK3: one ASCII grid for each tile, in a folder ``tile=`` of its own; a tile's text has to fit a row."""
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "line"))), lambda s: s["line"]), "\n")
    body = grid_lines(full).groupBy("tile_id").agg(lines.alias("body"))
    heads = [("ncols", "xsize"), ("nrows", "ysize"), ("xllcorner", "xleft"), ("yllcorner", "ybottom"), ("cellsize", "cell")]
    head = F.concat_ws("\n", *(F.concat_ws(" ", F.lit(k), F.col(c).cast("string")) for k, c in heads), F.lit(f"NODATA_value {empty}"))
    rows = body.join(grids, "tile_id").select(F.col("tile_id").alias("tile"), F.concat(head, F.lit("\n"), F.col("body")).alias("value"))
    rows.repartition("tile").write.partitionBy("tile").text(path)


#: ASCII's record separator, which ends a configuration in a file of many.
RECORD = "\x1e"


def write_registry(texts: DataFrame, path: str, text: str = "value", separator: str = RECORD) -> None:
    """SRC12: configuration texts, many in a file, each ended by ``separator``; a text that holds it raises."""
    bad = F.raise_error(F.lit("a configuration holds the separator")).cast("string")
    whole = F.when(F.col(text).contains(separator), bad).otherwise(F.coalesce(text, F.lit("")))
    texts.select(whole.alias("value")).write.option("lineSep", separator).text(path)


def tracks(
    photons: DataFrame, order: Column, by: tuple[str, ...] = ("granule_id1", "beam"), x: str = "longitude", y: str = "latitude", box: tuple[float, ...] | None = None
) -> DataFrame:
    """SNK4: each granule's beams as LINESTRING text, of the points in a box (ends included) where one is given; two points at least."""
    if box is not None:
        photons = in_box(photons, x, y, box, "closed")
    points = F.array_sort(F.collect_list(F.struct(order.alias("o"), F.concat_ws(" ", F.col(x).cast("string"), F.col(y).cast("string")).alias("p"))))
    rows = photons.groupBy(*by).agg(points.alias("pts")).where(F.size("pts") >= 2)
    return rows.select(*by, F.size("pts").alias("n_points"), F.concat(F.lit("LINESTRING ("), F.array_join("pts.p", ", "), F.lit(")")).alias("wkt"))


def replace_table(df: DataFrame, path: str) -> None:
    """SRC13: write a table back in place of the one that it may be read from; the former version stays as ``<path>.old``."""
    df.write.mode("overwrite").parquet(f"{path}.new")
    rename(df.sparkSession, path, f"{path}.old")
    rename(df.sparkSession, f"{path}.new", path)


def convert(df: DataFrame, path: str) -> None:
    """SNK5: any table as Zstandard Parquet."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def value_ranges(cells: DataFrame, by: str = "filename", value: str = "value") -> DataFrame:
    """SNK7: least, greatest, mean and deviation of each file."""
    return cells.groupBy(by).agg(F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
