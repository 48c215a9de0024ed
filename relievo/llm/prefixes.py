"""The prefix trie of conversations, with a count-min sketch that keeps unshared tails out of the shuffle.

A conversation of n turns has n + 1 prefixes, each under a 128-bit digest: the running
XOR of two 64-bit hashes of (place, role, text). Most prefixes belong to one
conversation only, and what follows one of them does too.

1. *Screening.* Every task counts its digests, up to two, in a count-min sketch of two
   rows, one for each half of the digest; the sketches are added up by blocks of cells.
   The estimate of a digest is the lesser of its cells and never too low, so an estimate
   of one proves that its prefix is one conversation's alone.
2. *Tails.* A proven prefix below another proven one of its conversation is a node whose
   every value is known where it stands: it goes out at once and is never shuffled.
3. *Exact grouping.* Only prefixes that may be shared meet by digest, summed up in each
   task before they move.

Values over subtrees need no walk through the trie. A node is owned by its smallest
member; a conversation owns the nodes of its path from some depth on. Members of a node
and what they own then say all of it by sums over the members: a child is owned by one
of them, so is each leaf, and the tokens that sharing saves below a node are the bytes of
its members' turns from there to the first node that they own.

Hot keys: turns of a conversation are numbered and hashed in blocks of BLOCK turns that
are joined by offsets, so a conversation with a third of all turns is many tasks' work
(turns of one number within it are ordered together, by role and text). A prefix of a
third of all conversations is one row for each task before it moves; its members' ids
are sorted by range and hashed from ordered pieces, so no task holds them all.
Where a parent has many children that others own, they look up its owner by an equi-join
whose large partitions adaptive execution splits.

The sketch has at least four cells for a prefix, up to MOST_CELLS a row: a byte each while
tasks count (256 MB in both rows at most), a bit each once added up, which is what the driver
passes on (32 MB at most). Beyond that more prefixes take the exact way, and the result
stays the same.

Defined cases: a null role or text is empty; null turns come first; turns of one number are
ordered by role, then text; repeated rows are turns each; rows without conv_id belong to no
conversation; a rebuilt conversation may have no turns and is a member of the root
alone; an empty table has no root; texts are hashed whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from relievo.plans.storage import materialize, scratch
from relievo.plans.text import text_or_empty

#: Turns of a conversation that one window holds.
BLOCK = 512
#: Conversations of one family share their first turns: as many as a checksum says, below this number.
FAMILY, MOST_SHARED = 5, 9
#: Cells of a row of the sketch, at least and at most, and of one of its blocks.
LEAST_CELLS, MOST_CELLS, _BLOCK_CELLS = 1 << 16, 1 << 27, 1 << 16

_KEY = ["x1", "x2", "depth"]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _numbered(turns: DataFrame) -> DataFrame:
    """``(conv_id, k, h1, h2, size)``: a turn's place in its conversation, two hashes of it, the bytes of its text."""
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text_or_empty("role").alias("role"), text_or_empty().alias("text")
    )
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))))
    placed = rows.select(
        "conv_id", "block", (F.row_number().over(Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "role", "text")) - 1).cast("long").alias("k"),
        F.xxhash64(F.lit(1), "role", "text").alias("h1"), F.xxhash64(F.lit(2), "text", "role").alias("h2"), F.octet_length("text").cast("long").alias("size"),
    )
    return _offset(placed, [F.count("*").alias("n")], {"k": lambda before: F.col("k") + F.coalesce(before["n"], F.lit(0))}, {"n": F.sum})


def _offset(rows: DataFrame, totals: list[Column], moved: dict, over: dict) -> DataFrame:
    """Blocks of conversations put together: columns ``moved`` by what the blocks before theirs hold in total.

    Only conversations of several blocks have offsets to join; for all others the
    values stand.
    """
    per = rows.groupBy("conv_id", "block").agg(*totals)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(F.col("conv_id").alias("o_conv"), F.col("block").alias("o_block"), *(f(c).over(before).alias(f"o_{c}") for c, f in over.items()))
    offsets = offsets.where(F.col(f"o_{next(iter(over))}").isNotNull())
    joined = rows.join(offsets, (F.col("conv_id") == F.col("o_conv")) & (F.col("block") == F.col("o_block")), "left")
    return joined.withColumns({c: f({k: F.col(f"o_{k}") for k in over}) for c, f in moved.items()}).drop("o_conv", "o_block", *(f"o_{k}" for k in over))


def _rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations ``(conv_id, base, shared, n_base, n)``, and their turns ``(conv_id, depth, h1, h2, size)``."""
    lengths = numbered.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    convs = lengths.select("conv_id", "n_own", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).alias("h"))
    convs = convs.join(lengths.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_there")), "base", "left")
    convs = convs.withColumn("n_base", F.least("h", F.coalesce("n_there", F.lit(0))))
    convs = convs.withColumn("n", F.col("n_base") + F.greatest(F.lit(0), F.col("n_own") - F.col("h"))).select("conv_id", "base", "h", "n_base", "n")
    own = numbered.join(convs, "conv_id").where("k >= h").select("conv_id", (F.col("n_base") + F.col("k") - F.col("h") + 1).alias("depth"), "h1", "h2", "size", "n")
    heads = numbered.where(f"k < {MOST_SHARED} and conv_id % {FAMILY} = 0").withColumnRenamed("conv_id", "base")
    shared = heads.join(convs, "base").where("k < h").select("conv_id", (F.col("k") + 1).alias("depth"), "h1", "h2", "size", "n")
    return convs, own.unionByName(shared)


def _digested(turns: DataFrame) -> DataFrame:
    """Every prefix but the root: its digest ``x1, x2``, its parent's ``p1, p2``, bytes of its last turn and of all, whether its conversation ends."""
    rows = turns.withColumn("block", F.floor(F.col("depth") / BLOCK)).withColumns(
        {"t1": F.xxhash64("depth", "h1"), "t2": F.xxhash64("depth", "h2")}
    )
    until = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select("conv_id", "block", "depth", "n", "t1", "t2", "size", F.bit_xor("t1").over(until).alias("x1"), F.bit_xor("t2").over(until).alias("x2"), F.sum("size").over(until).alias("total"))
    zero = F.lit(0).cast("long")
    rows = _offset(
        rows, [F.bit_xor("t1").alias("a1"), F.bit_xor("t2").alias("a2"), F.sum("size").alias("bytes")],
        {"x1": lambda o: F.col("x1").bitwiseXOR(F.coalesce(o["a1"], zero)), "x2": lambda o: F.col("x2").bitwiseXOR(F.coalesce(o["a2"], zero)), "total": lambda o: F.col("total") + F.coalesce(o["bytes"], zero)},
        {"a1": F.bit_xor, "a2": F.bit_xor, "bytes": F.sum},
    )
    return rows.select(
        "conv_id", "depth", "x1", "x2", F.col("x1").bitwiseXOR(F.col("t1")).alias("p1"), F.col("x2").bitwiseXOR(F.col("t2")).alias("p2"),
        "size", "total", (F.col("depth") == F.col("n")).alias("ends"),
    )


def _cells(values: np.ndarray, cells: int) -> np.ndarray:
    return (values.astype(np.int64).view(np.uint64) & np.uint64(cells - 1)).astype(np.int64)


_SKETCH = "line int, block int, counts binary"
_SKETCH_ARROW = pa.schema([("line", pa.int32()), ("block", pa.int32()), ("counts", pa.binary())])


def _sketch(cells: int, size: int):
    """Each task's sketch: for every row and block of cells that it meets the counts, two standing for more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for line in (0, 1):
                at, n = np.unique(_cells(batch.column(line).to_numpy(zero_copy_only=False), cells), return_counts=True)
                edges = np.searchsorted(at, np.arange(0, cells + 1, size))
                for b in np.flatnonzero(np.diff(edges)).tolist():
                    part = slice(edges[b], edges[b + 1])
                    held = blocks.setdefault((line, b), np.zeros(size, np.uint8))
                    place = at[part] - b * size
                    held[place] = np.minimum(held[place] + n[part], 2)
        for (line, b), held in blocks.items():
            yield pa.RecordBatch.from_arrays([pa.array([line], pa.int32()), pa.array([b], pa.int32()), pa.array([zlib.compress(held.tobytes(), 1)], pa.binary())], schema=_SKETCH_ARROW)

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sketches added up by block, which come sorted; a bit for each cell that counts one."""
    key, held = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([np.packbits(held == 1).tobytes()], pa.binary())], schema=_SKETCH_ARROW)

    for batch in batches:
        for line, block, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            here = np.frombuffer(zlib.decompress(counts), np.uint8)
            if key == (line, block):
                held = np.minimum(held + here, 2)
                continue
            if key:
                yield done()
            key, held = (line, block), here
    if key:
        yield done()


def screen(prefixes: DataFrame, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of the sketch a bit for every cell that counts one: ``cells / 4`` bytes at the driver in all."""
    size = min(cells, _BLOCK_CELLS)
    parts = prefixes.select("x1", "x2").mapInArrow(_sketch(cells, size), _SKETCH)
    added = parts.repartition("line", "block").sortWithinPartitions("line", "block").mapInArrow(_added, _SKETCH)
    bits = np.zeros((2, cells // 8), np.uint8)
    for r in added.toLocalIterator():
        bits[r["line"], r["block"] * size // 8 : (r["block"] + 1) * size // 8] = np.frombuffer(r["counts"], np.uint8)
    return bits[0], bits[1]


def proven(ones: tuple[np.ndarray, np.ndarray], x1: np.ndarray, x2: np.ndarray) -> np.ndarray:
    """Which digests the sketch estimates at one."""
    out = np.zeros(len(x1), bool)
    for bits, x in zip(ones, (x1, x2), strict=True):
        at = _cells(x, 8 * len(bits))
        out |= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return out


_PREFIX = "conv_id bigint, depth bigint, x1 bigint, x2 bigint, p1 bigint, p2 bigint, size bigint, total bigint, ends boolean"


def _classed(sent):
    """Adds ``kind``: a tail below a proven prefix, a proven prefix that may begin a tail, or one that may be shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, -1, False)
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, depth, x1, x2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            one = proven(sent.value, x1, x2)
            follows = np.empty(len(one), bool)
            follows[0] = last == (conv[0], depth[0] - 1, True)
            follows[1:] = (conv[1:] == conv[:-1]) & (depth[1:] == depth[:-1] + 1) & one[:-1]
            kind = np.where(one, np.where(follows, "tail", "first"), "maybe")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kind, pa.string())], names=[*batch.schema.names, "kind"])
            last = (conv[-1], depth[-1], bool(one[-1]))

    return run


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids that come sorted by node, put together to pieces of at most 4096 ids of one node."""
    kind = pa.schema([("x1", pa.int64()), ("x2", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
    key, held = None, []

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*key, held[0], ",".join(map(str, held))), kind, strict=True)], schema=kind)

    for batch in batches:
        for x1, x2, depth, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != (x1, x2, depth) or len(held) == 4096:
                if held:
                    yield done()
                key, held = (x1, x2, depth), []
            held.append(conv)
    if held:
        yield done()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's pieces, which come in order, one at a time."""
    kind = pa.schema([("x1", pa.int64()), ("x2", pa.int64()), ("depth", pa.int64()), ("sha", pa.string())])
    key, state = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*key, state.hexdigest()), kind, strict=True)], schema=kind)

    for batch in batches:
        for x1, x2, depth, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key == (x1, x2, depth):
                state.update(b",")
            else:
                if key:
                    yield done()
                key, state = (x1, x2, depth), hashlib.sha256()
            state.update(ids.encode())
    if key:
        yield done()


def _ends(maybe: DataFrame) -> DataFrame:
    """``(x1, x2, depth, sha)``: the hash of the ids that end at a node, in order."""
    ends = maybe.where("ends").select(*_KEY, "conv_id")
    parts = max(1, int(maybe.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pieces = ends.repartitionByRange(parts, *_KEY, "conv_id").sortWithinPartitions(*_KEY, "conv_id").mapInArrow(_pieces, "x1 bigint, x2 bigint, depth bigint, first bigint, ids string")
    return pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(_hashed, "x1 bigint, x2 bigint, depth bigint, sha string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """A row for each node: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``."""
    spark = turns.sparkSession
    with scratch(spark, "trie") as keep:
        convs, rebuilt = _rebuilt(keep(_numbered(turns), "numbered"))
        prefixes = keep(_digested(rebuilt).sortWithinPartitions("conv_id", "depth"), "prefixes")
        n, cells = prefixes.count(), LEAST_CELLS
        while cells < min(4 * n, MOST_CELLS):
            cells *= 2
        sent = spark.sparkContext.broadcast(screen(prefixes, cells))
        none = F.lit(0).cast("long")
        root = convs.select(
            "conv_id", none.alias("depth"), none.alias("x1"), none.alias("x2"), none.alias("p1"), none.alias("p2"), none.alias("size"), none.alias("total"), (F.col("n") == 0).alias("ends"),
        )
        classed = keep(prefixes.mapInArrow(_classed(sent), f"{_PREFIX}, kind string").unionByName(root.withColumn("kind", F.lit("maybe"))), "classed")
        maybe, first, tail = (classed.where(F.col("kind") == k).drop("kind") for k in ("maybe", "first", "tail"))
        owners = keep(
            maybe.groupBy(*_KEY).agg(
                F.min("conv_id").alias("owner"), F.first("size").alias("size"), F.first("total").alias("total"), (F.count("*") == F.count_if("ends")).alias("leaf"),
            ),
            "owners",
        )
        #: Where each conversation's own nodes begin, the bytes before, and whether its end is a leaf that it owns.
        begins = F.struct("depth", "bytes").alias("begin")
        one = F.lit(1).cast("long")
        own = owners.select(F.col("owner").alias("conv_id"), "depth", (F.col("total") - F.col("size")).alias("bytes"), F.col("leaf").cast("long").alias("leaf"))
        own = own.unionByName(first.select("conv_id", "depth", (F.col("total") - F.col("size")).alias("bytes"), one.alias("leaf")))
        own = own.unionByName(maybe.where("ends").select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("total").alias("bytes"), none.alias("leaf")))
        own = own.groupBy("conv_id").agg(F.min(begins).alias("begin"), F.max("leaf").alias("leaf")).select("conv_id", F.col("begin.depth").alias("own_depth"), F.col("begin.bytes").alias("own_bytes"), "leaf")
        members = maybe.join(own, "conv_id")
        nodes = members.groupBy(*_KEY).agg(
            F.min(F.struct("conv_id", "own_depth")).alias("least"), F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.count("*").alias("n_convs"), F.count_if("ends").alias("n_ends"),
            F.count_if((F.col("own_depth") <= F.col("depth") + 1) & ~F.col("ends")).alias("n_children"), F.sum("leaf").alias("n_leaves"),
            F.sum(F.greatest(none, F.col("own_bytes") - (F.col("total") - F.col("size")))).alias("saved_tokens"),
        )
        nodes = keep(nodes.join(_ends(maybe), _KEY, "left").withColumn("sha", F.coalesce("sha", F.lit(_NO_ENDS))), "nodes")
        at_root = owners.where("depth = 0").select("owner").first()
        root_id = F.lit(at_root["owner"] if at_root else None).cast("long")
        ends_alone = lambda ends: F.when(ends, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(_NO_ENDS)
        values = ["n_convs", "n_children", "n_leaves", "saved_tokens", "sha"]
        alone = [one.alias("n_convs"), (~F.col("ends")).cast("long").alias("n_children"), one.alias("n_leaves"), none.alias("saved_tokens"), ends_alone(F.col("ends")).alias("sha")]
        shared = nodes.select(F.col("least.conv_id").alias("conv_id"), "depth", "p1", "p2", (F.col("least.own_depth") < F.col("depth")).alias("own_parent"), *values)
        heads = first.select("conv_id", "depth", "p1", "p2", F.lit(False).alias("own_parent"), *alone)
        known = shared.where("own_parent or depth < 2").unionByName(heads.where("depth < 2"))
        known = known.withColumn("parent_conv_id", F.when(F.col("depth") == 1, root_id).when(F.col("depth") > 1, F.col("conv_id")))
        asked = shared.where("not own_parent and depth > 1").unionByName(heads.where("depth > 1"))
        parents = owners.select(F.col("x1").alias("p1"), F.col("x2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent_conv_id"))
        asked = asked.join(parents, ["p1", "p2", "depth"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "conv_id"))
        tails = tail.select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), *alone)
        columns = ["conv_id", "depth", "parent_conv_id", *values]
        out = known.select(columns).unionByName(asked.select(columns)).unionByName(tails.select(columns)).withColumnRenamed("sha", "ends_sha256")
        try:
            return materialize(out, "trie-nodes")
        finally:
            sent.destroy()
