"""Photons clustered along a space-filling curve (SNK1, SRC3): files of code ranges, a catalogue of them, box reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relievo.operators.filters import in_box

#: Bits of a code for each axis: cells of 1.2 m at the equator.
BITS = 25
#: Intervals that stand for a box, at most.
MOST_INTERVALS = 48
CODE = "z_code"


def _spread(v: Column) -> Column:
    """The lower 31 bits of a number with a zero after each."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return v


def _cell(v: Column, low: float, width: float, bits: int) -> Column:
    """The place of a coordinate among 2^bits cells; what lies outside goes to the first or last."""
    top = (1 << bits) - 1
    return F.least(F.lit(top), F.greatest(F.lit(0), F.floor((v - low) / width * (1 << bits)))).cast("long")


def morton(x: Column, y: Column, bits: int = BITS) -> Column:
    """The Morton code of a longitude and a latitude: bits of both, longitude in the even places."""
    return _spread(_cell(x, -180.0, 360.0, bits)).bitwiseOR(F.shiftleft(_spread(_cell(y, -90.0, 180.0, bits)), 1))


def box_intervals(box: Sequence[float], bits: int = BITS, most: int = MOST_INTERVALS) -> list[tuple[int, int]]:
    """Closed intervals of codes that hold every point of a box, ends included; few, so they may hold more.

    Quadrants that the box covers are intervals; of those that it cuts, the largest
    are cut further until there are ``most``.
    """
    place = lambda v, low, width: min((1 << bits) - 1, max(0, int((v - low) / width * (1 << bits) // 1)))
    x0, x1 = place(box[0], -180.0, 360.0), place(box[2], -180.0, 360.0)
    y0, y1 = place(box[1], -90.0, 180.0), place(box[3], -90.0, 180.0)
    if box[0] > box[2] or box[1] > box[3]:
        return []
    whole, cut = [], [(bits, 0, 0, 0)]  # size of a quadrant, its corner, its first code
    while cut and len(whole) + len(cut) < most:
        level, x, y, code = cut.pop(0)  # the largest come first
        if level == 0:
            whole.append((code, code))
            continue
        half = 1 << (level - 1)
        for k in range(4):
            qx, qy, first = x + (k & 1) * half, y + (k >> 1) * half, code + (k << (2 * (level - 1)))
            if qx > x1 or qx + half - 1 < x0 or qy > y1 or qy + half - 1 < y0:
                continue
            if x0 <= qx and qx + half - 1 <= x1 and y0 <= qy and qy + half - 1 <= y1:
                whole.append((first, first + (1 << (2 * (level - 1))) - 1))
            else:
                cut.append((level - 1, qx, qy, first))
    rest = [(code, code + (1 << (2 * level)) - 1) for level, _, _, code in cut]
    out: list[tuple[int, int]] = []
    for a, b in sorted(whole + rest):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def write_clustered(photons: DataFrame, path: str, x: str = "longitude", y: str = "latitude", files: int | None = None) -> DataFrame:
    """SNK1 as one table: photons dealt by ranges of their code, sorted by it in each file; the catalogue of the files.

    A dense place spreads over as many files as its share of the rows, whatever its
    extent, and a task writes one range. ``files`` is the number of ranges, the shuffle
    partitions by default. Extra columns stay; a former table at ``path`` is replaced.
    """
    spark = photons.sparkSession
    rows = photons.withColumn(CODE, morton(F.col(x), F.col(y)))
    # equal codes are told apart by the coordinates, so that one place cannot be all of a range
    dealt = rows.repartitionByRange(files or int(spark.conf.get("spark.sql.shuffle.partitions")), CODE, x, y)
    dealt.sortWithinPartitions(CODE, x, y).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return file_catalogue(spark, path)


def file_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Each file of a clustered table with its least and greatest code, its rows and bytes; reads the code alone."""
    rows = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size", CODE)
    return rows.groupBy(F.col("file_path").alias("file")).agg(
        F.min(CODE).alias("z_min"), F.max(CODE).alias("z_max"), F.count("*").alias("n"), F.first("file_size").alias("bytes")
    )


def _within(intervals: Sequence[tuple[int, int]], low: Column, high: Column) -> Column:
    out = F.lit(False)
    for a, b in intervals:
        out = out | ((low <= b) & (high >= a))
    return out


def files_for_box(catalogue: DataFrame, box: Sequence[float]) -> DataFrame:
    """The files that can hold points of a box."""
    return catalogue.where(_within(box_intervals(box), F.col("z_min"), F.col("z_max")))


def read_box(spark: SparkSession, path: str, catalogue: DataFrame, box: Sequence[float], x: str = "longitude", y: str = "latitude", edges: str = "left") -> DataFrame:
    """SRC3 from a clustered table: the photons of a box ``(xmin, ymin, xmax, ymax)``.

    The box becomes a few intervals of codes; only files whose codes meet one are
    opened (their names pass the driver), row groups of other codes are skipped
    by the same intervals, and the box itself is exact. ``edges`` as for :func:`in_box`.
    """
    names = [r["file"] for r in files_for_box(catalogue, box).select("file").collect()]
    table = spark.read.parquet(path)
    if not names:
        return table.limit(0).drop(CODE)
    rows = spark.read.schema(table.schema).parquet(*names)
    return in_box(rows.where(_within(box_intervals(box), F.col(CODE), F.col(CODE))), x, y, box, edges).drop(CODE)
