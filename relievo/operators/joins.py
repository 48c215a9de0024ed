"""Photon classification, raster joins, datalists and look-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relievo.plans.ranges import overlap_join


GROUP = ("granule", "beam")


def segment_starts(segments: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """The place of each segment's first photon in its granule's beam: an exclusive running count."""
    before = Window.partitionBy(*group).orderBy("segment_id").rowsBetween(Window.unboundedPreceding, -1)
    return segments.withColumn("start", F.coalesce(F.sum("cnt").over(before), F.lit(0)))


def classify(heights: DataFrame, segments: DataFrame, signal: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Each photon's class from signal rows (segment, 1-based index); -1 without one.

    Signal rows of unknown segments drop out.
    """
    starts = segment_starts(segments, group).select(*group, "segment_id", "start")
    placed = signal.join(starts, [*group, "segment_id"]).select(*group, (F.col("start") + F.col("idx") - 1).alias("pos"), "flag")
    return heights.join(placed, [*group, "pos"], "left").withColumn("class_code", F.coalesce("flag", F.lit(-1))).drop("flag")


def with_segments(heights: DataFrame, segments: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Segment attributes for each photon: an interval join as a carry-forward.

    Segment starts and photons of a group are sorted together by place; each
    photon takes the last start before it, if it lies within that segment.
    """
    starts = segment_starts(segments, group).where("cnt > 0")
    starts = starts.select(*group, F.col("start").alias("pos"), F.struct("segment_id", "start", "cnt", "geoid", "free2mean", "seg_dist").alias("s"))
    photons = heights.select(*group, "pos", F.struct(*heights.columns).alias("h"))
    both = starts.withColumn("h", F.lit(None).cast(photons.schema["h"].dataType)).unionByName(photons.withColumn("s", F.lit(None).cast(starts.schema["s"].dataType)))
    so_far = Window.partitionBy(*group).orderBy("pos", F.col("h").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = both.withColumn("s", F.last("s", ignorenulls=True).over(so_far)).where("h is not null and pos < s.start + s.cnt")
    joined = carried.select("h.*", "s.segment_id", "s.geoid", "s.free2mean", "s.seg_dist")
    return joined.withColumns({
        "h_geoid": F.col("h") - F.col("geoid"), "h_meantide": F.col("h") - (F.col("geoid") + F.col("free2mean")), "dist_x": F.col("seg_dist") + F.col("along"),
    })


def on_cells(photons: DataFrame, cells: DataFrame, keys: Sequence[str] = ("tile_id", "i", "j")) -> DataFrame:
    """Ground photons with the value of their cell."""
    return photons.join(cells, list(keys))


def occupied(cells: DataFrame, photons: DataFrame, keys: Sequence[str] = ("tile_id", "i", "j")) -> DataFrame:
    """Cells that hold at least one photon; a semi-join, so duplicates need no distinct."""
    return cells.join(photons.select(*keys), list(keys), "left_semi")


def without_rejected(photons: DataFrame, rejected: DataFrame, keys: Sequence[str] = ("granule_id1", "granule_id2")) -> DataFrame:
    """Photons of granules that are not on the reject list."""
    return photons.join(rejected.select(*keys), list(keys), "left_anti")


def datalist(tiles: DataFrame, sources: DataFrame, registry: DataFrame, size: float, excluded: Column | None = None) -> DataFrame:
    """For each target tile the active overlapping source files with their weights.

    ``excluded`` is a condition over ``l`` (tile), ``r`` (source) and the registry's columns.
    """
    pairs = overlap_join(tiles, sources, size)
    active = registry.where("is_active").select(F.col("id_number").alias("id"), "ranking_score", "dset_name")
    out = pairs.join(active, F.col("r.source_id") == F.col("id"))
    out = out if excluded is None else out.where(~excluded)
    return out.select(F.col("l.tile_id").alias("tile_id"), F.col("r.filename").alias("filename"), F.col("ranking_score").alias("weight"), "dset_name")


def matched(a: DataFrame, b: DataFrame, key: str, least_share: float = 0.5) -> DataFrame:
    """Keys in both products; fails while running when under ``least_share`` of ``a`` match."""
    both = a.select(key).distinct().join(b.select(key).distinct().withColumn("found", F.lit(True)), key, "left")
    share = both.agg(F.avg(F.col("found").isNotNull().cast("double")).alias("share"))
    checked = both.crossJoin(F.broadcast(share))  # one row
    kept = F.when(F.col("share") >= least_share, F.coalesce("found", F.lit(False))).otherwise(F.raise_error(F.lit("too few granules match")).cast("boolean"))
    return checked.where(kept).select(key)


def missing_companions(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that one side alone has, and which side lacks them."""
    sides = a.select(key).distinct().withColumn("in_a", F.lit(True)).join(b.select(key).distinct().withColumn("in_b", F.lit(True)), key, "full_outer")
    return sides.where("in_a is null or in_b is null").select(key, F.when(F.col("in_a").isNull(), "a").otherwise("b").alias("missing_in"))


def lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """A value by key; a row without one raises when it is evaluated."""
    out = rows.join(table.select(*keys, column), list(keys), "left")
    return out.withColumn(column, F.when(F.col(column).isNull(), F.raise_error(F.lit(f"{column} is missing")).cast(dict(out.dtypes)[column])).otherwise(F.col(column)))


def substituted(tiles: DataFrame, beds: DataFrame, key: str = "tile_id") -> DataFrame:
    """The bed version of a tile where exactly one exists, else the surface version."""
    single = beds.groupBy(key).agg(F.min("filename").alias("bed"), F.count("*").alias("n")).where("n = 1")
    return tiles.join(single.select(key, "bed"), key, "left").withColumn("filename", F.coalesce("bed", "filename")).drop("bed")


def unique_lookup(rows: DataFrame, scheme: DataFrame, key: str) -> DataFrame:
    """Attributes of a tile scheme; keys without exactly one entry raise when evaluated."""
    one = scheme.groupBy(key).agg(F.count("*").alias("__n"), F.min(F.struct(*(c for c in scheme.columns if c != key))).alias("__s"))
    bad = F.raise_error(F.lit("the tile scheme has no single entry for a tile")).cast(one.schema["__s"].dataType)
    return rows.join(one, key, "left").withColumn("__s", F.when(F.col("__n") == 1, F.col("__s")).otherwise(bad)).select(*rows.columns, "__s.*")


def exceptions(cells: DataFrame, rules: DataFrame) -> DataFrame:
    """The decision of the first rule in list order that fits a lake; null without one.

    ``cells`` are the lakes' cells ``(tile_id, lake, i, j)``. A rule ``(place,
    tile_id, row, col, decision, all_other)`` fits the lake that its cell is in;
    with row and column -1 it fits all lakes of its tile. A rule that fits a lake
    otherwise not, but is marked ``all_other``, decides false for it.
    """
    lakes = cells.select("tile_id", "lake").distinct()
    whole = F.expr("row = -1 and col = -1")
    at = rules.where(~whole).select("tile_id", F.col("row").alias("i"), F.col("col").alias("j"), "place", "decision")
    hits = cells.join(at, ["tile_id", "i", "j"]).select("tile_id", "lake", "place", "decision", F.lit(0).alias("rank"))
    wide = rules.where(whole | F.col("all_other")).select("tile_id", "place", F.when(whole, F.col("decision")).otherwise(F.lit(False)).alias("decision"), F.lit(1).alias("rank"))
    fits = hits.unionByName(lakes.join(wide, "tile_id").select("tile_id", "lake", "place", "decision", "rank"))
    first = fits.groupBy("tile_id", "lake").agg(F.min_by("decision", F.struct("place", "rank")).alias("decision"))
    return lakes.join(first, ["tile_id", "lake"], "left")


def translate_boxes(boxes: DataFrame, tiles: DataFrame, size: float, step: float) -> DataFrame:
    """Boxes cut at the tiles that they overlap, as rows and columns of the finer grid."""
    cut = overlap_join(boxes, tiles, size).withColumns({
        "x0": F.greatest("l.xmin", "r.xmin"), "x1": F.least("l.xmax", "r.xmax"), "y0": F.greatest("l.ymin", "r.ymin"), "y1": F.least("l.ymax", "r.ymax"),
    })
    at = lambda v: F.round(v / step).cast("bigint")
    return cut.select(
        "l", "r", at(F.col("r.ymax") - F.col("y1")).alias("i0"), at(F.col("r.ymax") - F.col("y0")).alias("i1"),
        at(F.col("x0") - F.col("r.xmin")).alias("j0"), at(F.col("x1") - F.col("r.xmin")).alias("j1"),
    )


def unprocessed(rows: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that the processed table does not have."""
    return rows.join(done.select(*keys), list(keys), "left_anti")


#: Files of a tag that stand together on the second side of its pairs.
TAG_BLOCK = 512


def by_tag(a: DataFrame, b: DataFrame, name_a: str, name_b: str, pattern: str, columns: Sequence[str] = (), spread: int = 16) -> DataFrame:
    """Files whose names carry the same tag, with ``columns`` of the companion.

    All pairs are made, which grow with the square of a tag's files. The first side is dealt to
    ``spread`` shares of each tag; the second is put together in blocks of at most TAG_BLOCK, which are repeated
    for each share, so one tag's pairs are made by several tasks. A task streams the pairs of a block with
    its share: the block's values recur within a page of a columnar file, which then takes a small
    dictionary and few bytes for a pair, however many files a tag has.
    """
    tag = lambda c: F.nullif(F.upper(F.regexp_extract(c, pattern, 0)), F.lit(""))
    share = lambda row: F.pmod(row, F.lit(spread)).cast("int")
    dealt = a.withColumns({"tag": tag(name_a), "__share": share(F.xxhash64(*a.columns))})
    other = b.select(tag(name_b).alias("tag"), F.struct(F.col(name_b).alias("companion"), *columns).alias("row")).where("tag is not null")
    other = other.withColumn("hash", F.xxhash64("row")).withColumn("dealt", share(F.col("hash")))
    place = F.row_number().over(Window.partitionBy("tag", "dealt").orderBy("hash"))
    other = other.withColumn("block", F.floor((place - 1) / TAG_BLOCK)).groupBy("tag", "dealt", "block").agg(F.collect_list("row").alias("rows"))
    other = other.select("tag", "rows", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("__share"))
    # a fixed number of shuffle partitions: few bytes make many pairs, so partitions must not be put together by bytes
    parts = max(spread, int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    on = ["tag", "__share"]
    # merged, with the blocks first: for each block the share's files are gone through
    met = other.repartition(parts, *on).hint("merge").join(dealt.repartition(parts, *on), on)
    return met.select("tag", *(c for c in a.columns if c != "tag"), F.inline("rows"))


def volume_corner(letter: Column, number: Column) -> Column:
    """Latitude and longitude of a volume tile's grid letter and number."""
    return F.struct((46 - (F.ascii(F.upper(letter)) - F.ascii(F.lit("A")))).alias("lat"), (number - 106).alias("lon"))
