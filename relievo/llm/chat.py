"""Chat formatting: logged snapshots of a conversation collapse to the longest.

Each turn gets two 64-bit hashes of its place, role and text; their running XOR
over a conversation identifies each prefix together with its length. A
conversation whose whole is a proper prefix of another one is dropped by an
anti-join; of equal conversations the least id stays. What is left is rendered.
All of it is DataFrame expressions, windows and joins.

Defined cases: null roles and texts equal each other and render as empty; turns
of a conversation are ordered by turn, then role and text, nulls first; repeated
(conversation, turn) rows all count; rows with a null conv_id are one
conversation; equal conversations without any id keep one; texts and conversations
are taken whole, of any length; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv_id, role, text, k, h1, h2, n)``: the hashes of the first k of n turns."""
    rows = turns.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("k", F.row_number().over(order))
    part = lambda seed: F.xxhash64(F.lit(seed), "k", F.col("role").isNull(), F.col("text").isNull(), F.coalesce("role", F.lit("")), F.lit("\0"), F.coalesce("text", F.lit("")))
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"t1": part(1), "t2": part(2)})
    return rows.select(
        "conv_id", "role", "text", "k",
        F.bit_xor("t1").over(running).alias("h1"), F.bit_xor("t2").over(running).alias("h2"),
        F.count("*").over(Window.partitionBy("conv_id")).alias("n"),
    )


def maximal(hashed: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, n_copies)`` of the conversations that no longer one starts with."""
    whole = hashed.where("k = n").groupBy("n", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    proper = hashed.where("k < n").select(F.col("k").cast("long").alias("n"), "h1", "h2").distinct()
    return whole.join(proper, ["n", "h1", "h2"], "left_anti").select("conv_id", F.col("n").alias("n_turns"), "n_copies")


def format_chats(turns: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, n_copies, text)`` of every maximal conversation."""
    hashed = prefixes(turns)
    kept = maximal(hashed)
    line = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("<|end|>\n"))
    lines = hashed.select("conv_id", F.struct("k", line.alias("line")).alias("part"))
    on = lines["conv_id"].eqNullSafe(kept["conv_id"])
    joined = lines.join(kept, on).select(kept["conv_id"], "n_turns", "n_copies", "part")
    texts = joined.groupBy("conv_id", "n_turns", "n_copies").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return texts.select("conv_id", "n_turns", "n_copies", F.array_join("parts.line", "").alias("text"))
