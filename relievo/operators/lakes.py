"""Lakes: connected cells, exceptions, bed choice, depths (G16, G17, MASK3)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relievo.operators.validation import lake_statistics
from relievo.plans.components import connected_components
from relievo.plans.storage import materialize, scratch


#: Cells of a side of the blocks that are labelled alone.
BLOCK = 1024


def label(cells: DataFrame, across_tiles: bool = False, block: int = BLOCK) -> DataFrame:
    """Cells with the least cell key of their four-connected lake.

    Components of a tile by default; ``across_tiles`` expects global indices. A
    cell's key is its row times 2^20 plus its column within a tile, and its row
    times 2^32 plus its column across tiles.

    Two levels: blocks of ``block`` by ``block`` cells are labelled each by itself in a
    task; then only cells beside a border between blocks meet their neighbours, and parts
    that touch there are contracted. What moves after the first exchange is in
    proportion to borders, and a lake of many blocks renames them part by part, so it is in no one task.
    """
    shift = 32 if across_tiles else 20
    spark = cells.sparkSession
    group = (F.lit(0) if across_tiles else F.col("tile_id")).cast("string")
    at = cells.withColumns({"__g": group, "__i": F.col("i").cast("long"), "__j": F.col("j").cast("long")})
    at = at.withColumns({"__bi": F.floor(F.col("__i") / block), "__bj": F.floor(F.col("__j") / block)})
    kinds = T.StructType([*at.schema.fields, T.StructField("__root", T.LongType())])
    found = materialize(at.groupBy("__g", "__bi", "__bj").applyInArrow(_labelled(shift), kinds), "labels")
    edge = found.where(f"__i % {block} in (0, {block - 1}) or __j % {block} in (0, {block - 1})").select("__g", "__i", "__j", F.struct("__g", "__root").alias("a"))
    pairs = []
    for di, dj in ((1, 0), (0, 1)):
        last = edge.where(f"{'__i' if di else '__j'} % {block} = {block - 1}")
        there = last.select("__g", (F.col("__i") + di).alias("__i"), (F.col("__j") + dj).alias("__j"), F.col("a").alias("b"))
        pairs.append(edge.where(f"{'__i' if di else '__j'} % {block} = 0").join(there, ["__g", "__i", "__j"]).select("a", "b"))
    with scratch(spark, "borders") as keep:
        links = keep(pairs[0].unionByName(pairs[1]).distinct(), "links")
        if links.isEmpty():
            return found.withColumn("lake", F.col("__root")).select(*cells.columns, "lake")
        parts = connected_components(links).select(F.col("node.__g").alias("__g"), F.col("node.__root").alias("__root"), F.col("component.__root").alias("lake"))
    return found.join(parts, ["__g", "__root"], "left").withColumn("lake", F.coalesce("lake", "__root")).select(*cells.columns, "lake")


def _labelled(shift: int):
    def run(table: pa.Table) -> pa.Table:
        """A block's cells with the least key of their component within it."""
        i, j = (table.column(c).to_numpy() for c in ("__i", "__j"))
        order = np.lexsort((j, i))
        si, sj = i[order], j[order]
        begins = np.ones(len(si), bool)
        begins[1:] = (si[1:] != si[:-1]) | (sj[1:] - sj[:-1] > 1)
        first = np.flatnonzero(begins)
        row, low, high = si[first], sj[first], sj[np.append(first[1:], len(si)) - 1]
        # runs of a row against runs of the next one, whose ends are ascending
        wide = np.int64(1) << 40
        from_, to = np.searchsorted(row * wide + high, (row + 1) * wide + low, "left"), np.searchsorted(row * wide + low, (row + 1) * wide + high, "right")
        n = np.maximum(to - from_, 0)
        above = np.repeat(np.arange(len(first)), n)
        beneath = np.repeat(from_ - np.cumsum(n) + n, n) + np.arange(n.sum())
        parent = list(range(len(first)))

        def root(k: int) -> int:
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            return k

        for x, y in zip(above.tolist(), beneath.tolist(), strict=True):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        least = np.array([root(k) for k in range(len(first))], np.int64)
        keys = np.empty(len(si), np.int64)
        keys[order] = ((row << shift) + low)[least][np.cumsum(begins) - 1]
        return table.append_column("__root", pa.array(keys))

    return run


def choose_beds(cells: DataFrame, forced: DataFrame | None = None, share: float = 0.8) -> DataFrame:
    """The bed of each lake cell.

    Layer ``bed_b`` serves a lake when at least ``share`` of its cells are below
    the modal surface or when it is forced, else ``bed_a``; cells not below the
    surface take the greatest lower value of their lake, or the surface minus one.
    """
    keys = ["tile_id", "lake"]
    stats = lake_statistics(cells, [], keys).select(*keys, "surface")
    rows = cells.join(stats, keys)
    below = rows.groupBy(*keys).agg(F.avg((F.col("bed_b") < F.col("surface")).cast("double")).alias("share_b"))
    rows = rows.join(below, keys)
    if forced is not None:
        rows = rows.join(forced.select(*keys, F.lit(True).alias("forced")), keys, "left")
    use = (F.col("share_b") >= share) | F.coalesce(F.col("forced"), F.lit(False)) if forced is not None else F.col("share_b") >= share
    rows = rows.withColumn("bed", F.when(use, F.col("bed_b")).otherwise(F.col("bed_a")))
    next_best = rows.where("bed < surface").groupBy(*keys).agg(F.max("bed").alias("next"))
    rows = rows.join(next_best, keys, "left")
    return rows.withColumn("bed", F.when(F.col("bed") < F.col("surface"), F.col("bed")).otherwise(F.coalesce("next", F.col("surface") - 1))).drop("next", "share_b", "forced")


def depths(
    lakes: DataFrame, cells: DataFrame, least_area: float | None = None, source: str = "layer", constant: float = 0.0, most_area: float | None = None, ids: DataFrame | None = None
) -> DataFrame:
    """MASK3: bed elevations of lakes: the surface minus a constant, mean or layered depth.

    Lakes count from ``least_area`` on, up to ``most_area``, and where ``ids``, a
    table with a column lake, names them; what is not given does not restrict.
    """
    depth = {"constant": F.lit(constant), "average": F.col("mean_depth"), "layer": F.col("depth")}[source]
    if least_area is not None:
        lakes = lakes.where(F.col("area") >= least_area)
    if most_area is not None:
        lakes = lakes.where(F.col("area") <= most_area)
    if ids is not None:
        lakes = lakes.join(ids.select("lake"), "lake", "left_semi")
    return cells.join(lakes, "lake").withColumn("bed", F.col("surface") - depth)
