"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from relievo.plans.storage import delete, materialize, new_folder, scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.where("b > a").join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def connected_components(edges: DataFrame, write: Callable[[DataFrame, str], DataFrame] = materialize, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node that an edge names, as a table that ``write`` makes.

    ``edges`` has two columns ``a`` and ``b`` of one orderable type; the
    component is its least node. Self-loops give components of one node, null
    ends are dropped, no edges give no rows. A round is written to the shared
    folder and deleted once the next one is there; the number of rounds grows
    with the logarithm of the longest path.
    """
    spark = edges.sparkSession
    edges = edges.select("a", "b").where("a is not null and b is not null")
    with scratch(spark, "contraction") as keep:
        named = keep(edges.distinct(), "named")
        nodes = named.select(F.col("a").alias("node")).unionByName(named.select(F.col("b").alias("node"))).distinct()
        current, digest, folder = named.where("a <> b"), None, None
        for _ in range(max_rounds):
            seen = Observation()
            rows = _small_star(_large_star(current)).observe(seen, F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"))
            last, folder = folder, new_folder(spark, "round")
            current = materialize(rows, "edges", folder)
            if last:
                delete(spark, last)
            if (seen.get["n"], seen.get["x"]) == digest:
                break
            digest = (seen.get["n"], seen.get["x"])
        else:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        found = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
        out = write(nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "components")
        delete(spark, folder)
        return out
