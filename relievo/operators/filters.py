"""Filters on photons, cells, tiles and names. All are narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def good_quality(df: DataFrame, quality: str = "quality_ph", land: str = "conf_land", ice: str = "conf_land_ice") -> DataFrame:
    """nominal photons of high confidence on land or land ice."""
    return df.where((F.col(quality) == 0) & ((F.col(land) == 4) | (F.col(ice) == 4)))


def signal(df: DataFrame, code: str = "class_code") -> DataFrame:
    """ground and canopy photons."""
    return df.where(F.col(code).between(1, 3))


def in_box(df: DataFrame, x: str, y: str, box: Sequence[float], edges: str = "left") -> DataFrame:
    """Rows in ``(xmin, ymin, xmax, ymax)``.

    ``edges``: ``left`` closes the lower ends (F3), ``raster`` closes xmin and
    ymax, as rows count downwards (F4), ``closed`` closes all (F5).
    """
    xmin, ymin, xmax, ymax = box
    cx, cy = F.col(x), F.col(y)
    if edges == "left":
        return df.where((cx >= xmin) & (cx < xmax) & (cy >= ymin) & (cy < ymax))
    if edges == "raster":
        return df.where((cx >= xmin) & (cx < xmax) & (cy > ymin) & (cy <= ymax))
    if edges == "closed":
        return df.where(cx.between(xmin, xmax) & cy.between(ymin, ymax))
    raise ValueError(f"unknown edges: {edges}")


def outside_boxes(df: DataFrame, x: str, y: str, boxes: Sequence[Sequence[float]], least_y: float | None = None) -> DataFrame:
    """rows in none of the boxes, not south of ``least_y``."""
    bad = F.lit(False)
    for xmin, ymin, xmax, ymax in boxes:
        bad = bad | (F.col(x).between(xmin, xmax) & F.col(y).between(ymin, ymax))
    out = df.where(~bad)
    return out if least_y is None else out.where(F.col(y) >= least_y)


def valid_land(df: DataFrame, value: str = "value", mask: str = "land", ndv: float | None = None) -> DataFrame:
    """land cells with a value; ``ndv`` None means null alone is missing."""
    out = df.where((F.col(mask) > 0) & F.col(value).isNotNull())
    return out if ndv is None else out.where(F.col(value) != ndv)


def reliable(df: DataFrame, count: str = "n_trim", measure: str = "diff_mean", least: int = 3, empty: float = -99999.0) -> DataFrame:
    """F8: cells with over ``least`` trimmed photons and a measure."""
    c = F.col(measure)
    return df.where((F.col(count) > least) & c.isNotNull() & ~F.isnan(c) & (c != empty))


def small_error(df: DataFrame, cutoff: float, measure: str = "diff_mean") -> DataFrame:
    """cells whose error is at most the cutoff."""
    return df.where(F.abs(F.col(measure)) <= cutoff)


def coverage_levels(df: DataFrame, levels: Sequence[int], coverage: str = "coverage") -> DataFrame:
    """a row for each level in per cent that the coverage reaches; a short list explodes."""
    reached = F.filter(F.array(*map(F.lit, levels)), lambda p: F.col(coverage) >= p / 100.0)
    return df.withColumn("level", F.explode(reached))


def quality_segments(df: DataFrame, passed: str, surfaces: str, land_only: bool = False) -> DataFrame:
    """segments of passing granules over land; with ``land_only`` over nothing else."""
    s = F.col(surfaces)
    out = df.where(F.col(passed) & (F.get(s, 0) == 1))
    return out.where(F.aggregate(F.slice(s, 2, 4), F.lit(0), lambda a, x: a + x) == 0) if land_only else out


def band_subset(df: DataFrame, x: str, y: str, width: float, ymin: float, ymax: float) -> DataFrame:
    """rows of a latitude band with their longitude bin, ready to partition by it."""
    return df.where((F.col(y) >= ymin) & (F.col(y) < ymax)).withColumn("lon_bin", F.floor(F.col(x) / width) * width)


def by_name(df: DataFrame, name: str, keep: str | None = None, omit: str | None = None) -> DataFrame:
    """names that match one pattern and not the other."""
    out = df if keep is None else df.where(F.col(name).rlike(keep))
    return out if omit is None else out.where(~F.col(name).rlike(omit))


def outside_rectangles(cells: DataFrame, boxes: DataFrame, tile: str = "tile_id") -> DataFrame:
    """cells in no box ``(i0, i1, j0, j1)`` of their tile; ends are exclusive.

    Box tables are small; a tile's boxes still join by tile, so size does not matter.
    """
    on = (F.col(f"c.{tile}") == F.col(f"b.{tile}")) & F.expr("c.i >= b.i0 and c.i < b.i1 and c.j >= b.j0 and c.j < b.j1")
    return cells.alias("c").join(boxes.alias("b"), on, "left_anti")


def cleaned(cells: DataFrame, rules: DataFrame | None = None, drop_gte0: bool = True, drop_empty: bool = True, value: str = "value") -> DataFrame:
    """bad values set to null, and tiles without any value left dropped.

    A rule ``(tile_id, badvalue, i0, i1, j0, j1)`` names a value of a tile, or else
    a box with exclusive ends. ``drop_gte0`` takes all heights from 0 on.
    """
    out = cells
    if rules is not None:
        exact = rules.where("badvalue is not null").select("tile_id", F.col("badvalue").alias(value), F.lit(True).alias("__bad")).distinct()
        out = out.join(exact, ["tile_id", value], "left").withColumn(value, F.when(F.col("__bad").isNull(), F.col(value))).drop("__bad").select(*cells.columns)
        boxes = rules.where("badvalue is null").select("tile_id", "i0", "i1", "j0", "j1")
        kept = outside_rectangles(out, boxes)
        out = kept.unionByName(out.alias("c").join(boxes.alias("b"), F.expr("c.tile_id = b.tile_id and c.i >= b.i0 and c.i < b.i1 and c.j >= b.j0 and c.j < b.j1"), "left_semi").withColumn(value, F.lit(None).cast(cells.schema[value].dataType)))
    if drop_gte0:
        out = out.withColumn(value, F.when(F.col(value) < 0, F.col(value)))
    if drop_empty:
        out = out.join(out.where(F.col(value).isNotNull()).select("tile_id").distinct(), "tile_id", "left_semi")
    return out.select(*cells.columns)


def without_codes(cells: DataFrame, code: str, codes: Sequence[int]) -> DataFrame:
    """cells whose source type is not on the list; null codes stay."""
    return cells.where(~F.coalesce(F.col(code).isin(list(codes)), F.lit(False)))


def without_contributors(cells: DataFrame, attributes: DataFrame, text: str, contributor: str = "contributor") -> DataFrame:
    """F16: drop interpolated cells (0) and contributors whose institution holds ``text``."""
    bad = attributes.where(F.col("institution").contains(text)).select(F.col(contributor))
    return cells.where(F.col(contributor) != 0).join(bad, contributor, "left_anti")


def replace_missing(cells: DataFrame, value: str, old: float | None, new: float) -> DataFrame:
    """one sentinel for another; null counts as missing."""
    c = F.col(value)
    return cells.withColumn(value, F.coalesce(F.nullif(c, F.lit(old)) if old is not None else c, F.lit(new)))


def same_grid(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("tile_id",), tolerance: float = 1e-12) -> DataFrame:
    """Grids of ``a`` that differ from those of ``b``; empty when all agree."""
    columns = ["xleft", "ytop", "xres", "yres"]
    both = a.alias("a").join(b.alias("b"), list(keys), "full_outer")
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.coalesce(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) <= tolerance, F.lit(False))
    return both.where(differs).select(*keys)


def trim_to(cells: DataFrame, other: DataFrame, keys: Sequence[str] = ("tile_id", "i", "j")) -> DataFrame:
    """cells that have a value in the other raster on the same grid."""
    return cells.join(other.select(*keys), list(keys), "left_semi")


def tile_fill(cells: DataFrame, expected: int, mode: str = "any", tile: str = "tile_id", value: str = "value") -> DataFrame:
    """tiles with at least one value (``any``) or with no cell missing (``full``)."""
    n = cells.groupBy(tile).agg(F.count(value).alias("n_valid"))
    return n.where(F.col("n_valid") > 0) if mode == "any" else n.where(F.col("n_valid") >= expected)


def mask_by_region(df: DataFrame, region: str, code: str, value: str, geoid: str) -> DataFrame:
    """north keeps code 4, the southern bed codes below 2, the southern surface all; then adds the geoid."""
    kept = (
        F.when(F.col(region) == "north", F.col(code) == 4).when(F.col(region) == "south_bed", F.col(code) < 2).otherwise(F.col(region) == "south_surface")
    )
    return df.where(kept).withColumn(value, F.col(value) + F.col(geoid))


def without_empty_masks(df: DataFrame, mask: str = "land", tile: str = "tile_id") -> DataFrame:
    """drop tiles whose mask is zero everywhere, with all that depends on them."""
    empty = df.groupBy(tile).agg(F.max(mask).alias("m")).where(F.coalesce("m", F.lit(0)) == 0).select(tile)
    return df.join(empty, tile, "left_anti")
