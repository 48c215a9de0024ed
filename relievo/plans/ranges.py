"""Box overlap joins over a grid key; R3: partition bounds beside a box predicate."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOX = ("xmin", "ymin", "xmax", "ymax")


#: Levels of the grid: cells of 2^60 times the least size hold anything.
_TOP = 60


def _cells(low: Column, high: Column, size: Column) -> Column:
    """The grid cells that an interval open at both ends meets."""
    first = F.floor(low / size)
    return F.sequence(first, F.greatest(first, F.ceil(high / size) - 1))


def _level(size: float) -> Column:
    """The level whose cells are as large as a box, which then meets few of them."""
    side = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    return F.when(side > size, F.least(F.lit(_TOP), F.ceil(F.log2(side / size)))).otherwise(0).cast("int")


def overlap_join(left: DataFrame, right: DataFrame, size: float) -> DataFrame:
    """Pairs of boxes that overlap and not merely touch, as structs ``l`` and ``r``.

    A grid of levels: cells of ``size`` at the lowest, twice as large at each next
    one. A box is at home at the level of its own side, where it meets four cells or so,
    and looks for larger ones at the levels above that the other side has boxes of;
    pairs meet at the home level of the larger box. So a box over the whole map and one of a few metres
    both make a bounded number of rows. A pair that shares several cells is kept in
    the one that holds the lower corner of its intersection, so there is no second
    shuffle for duplicates. ``size`` is about the larger side of the smallest common
    boxes. The levels in use, sixty numbers at most, are asked for first.
    """
    sides = {"l": left, "r": right}
    found = [df.select(F.lit(name).alias("side"), _level(size).alias("level")) for name, df in sides.items()]
    rows = found[0].unionByName(found[1]).distinct().collect()
    in_use = {name: sorted(r["level"] for r in rows if r["side"] == name and r["level"] is not None) for name in sides}

    def spread(name: str, other: str) -> DataFrame:
        bounds = [F.col(c).alias(f"{name}_{c}") for c in BOX]
        at = sides[name].select(F.struct(*sides[name].columns).alias(name), *bounds, _level(size).alias(f"{name}_home"))
        above = F.array(*map(F.lit, in_use[other])).cast("array<int>")
        levels = F.array_union(F.array(f"{name}_home"), F.filter(above, lambda v: v > F.col(f"{name}_home")))
        at = at.withColumn("level", F.explode(levels))
        cell = size * F.pow(F.lit(2.0), F.col("level"))
        return at.withColumn("cx", F.explode(_cells(F.col(f"{name}_xmin"), F.col(f"{name}_xmax"), cell))).withColumn("cy", F.explode(_cells(F.col(f"{name}_ymin"), F.col(f"{name}_ymax"), cell)))

    pairs = spread("l", "r").join(spread("r", "l"), ["level", "cx", "cy"])
    meets = F.expr("l_xmin < r_xmax and l_xmax > r_xmin and l_ymin < r_ymax and l_ymax > r_ymin and level = greatest(l_home, r_home)")
    cell = size * F.pow(F.lit(2.0), F.col("level"))
    corner = (F.floor(F.greatest("l_xmin", "r_xmin") / cell) == F.col("cx")) & (F.floor(F.greatest("l_ymin", "r_ymin") / cell) == F.col("cy"))
    return pairs.where(meets & corner).select("l", "r")


def around(x: Column, width: float) -> Column:
    """The western edge of the block of ``width`` degrees that holds a longitude, counted around the globe: 360 / width blocks, whatever the longitudes."""
    n = math.ceil(360 / width)
    return (F.pmod(F.floor(x / width) + n // 2, F.lit(n)) - n // 2) * width


def edge(v: float, width: float) -> float:
    """The lower edge of the step of ``width`` that holds a number."""
    return math.floor(v / width) * width if math.isfinite(v) else v


def around_between(block: Column, low: float, high: float, width: float) -> Column:
    """Whether a block of :func:`around` can hold a longitude from ``low`` to ``high``."""
    n = math.ceil(360 / width)
    if not high - low < (n - 1) * width:
        return F.lit(True)
    first, last = (((math.floor(v / width) + n // 2) % n - n // 2) * width for v in (low, high))
    return block.between(first, last) if first <= last else (block >= first) | (block <= last)


def pruned(df: DataFrame, x: str, y: str, box: Sequence[float], tile: float, tile_x: str = "tile_lon", tile_y: str = "tile_lat") -> DataFrame:
    """A box filter together with bounds on the partition columns that it implies."""
    xmin, ymin, xmax, ymax = box
    low = lambda v: F.floor(F.lit(float(v)) / tile) * tile
    bounds = F.col(tile_x).between(low(xmin), low(xmax)) & F.col(tile_y).between(low(ymin), low(ymax))
    inside = (F.col(x) >= xmin) & (F.col(x) < xmax) & (F.col(y) >= ymin) & (F.col(y) < ymax)
    return df.where(bounds & inside)
