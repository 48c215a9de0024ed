"""N-gram Jaccard join by prefix filters under several global token orders.

A document's set holds its distinct five-word shingles as 64-bit hashes. A global
order sorts tokens by how often they occur (rare first, in classes of powers of
two of a fixed-size count table over all documents) and by a hash of its own
within a class. Two sets with Jaccard similarity of at least 0.8 share tokens in
their prefixes under every such order, and a pair has to pass all of them, in
joins, before any text moves.

Equal sets are one node from the start. The first order's prefixes form the index
of nodes, with each token's place in its node's order. Linked sets of sizes a and b
share at least ``o = 0.8 (a + b) / 1.8`` tokens, so the first one that they share
has at most ``a - o`` and ``b - o`` tokens before it; this bound of the two places
is part of every join condition. A token serves if one of its nodes has it in the
first ninth, the most that the smaller set of a pair can have before it.

The index goes through rounds. In a round each node meets one centre of its
posting lists only, verified links become components, and lists whose nodes are
all in one component are done. Rounds end when they link few nodes; the pairs
across components that are left are then all tried. A pair that met
in the index goes on if its prefixes under each other order share as many tokens
as linked sets of these sizes must. So a group of thousands of near copies costs
about one comparison a member, and no link between different components is lost.

Defined cases: null and empty texts, and texts of white space, have an empty set,
link with nothing and are their own component; a null doc_id takes part, and its
component is the least non-null id of its group (null if there is none); repeated
rows come back as often as they went in; an empty table gives an empty result;
texts are taken whole, very long ones alone; sets of equal rank in an order are
told apart by their tokens' values; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relievo.llm.tokens import slices
from relievo.plans.components import connected_components
from relievo.plans.storage import drop_shuffles, materialize, scratch
from relievo.plans.text import id_kind, id_of, text_or_empty

WORDS = 5
NUMERATOR, DENOMINATOR = 80, 100
#: Cells of the count table: its size does not depend on the data.
CELLS = 1 << 20
_SLICES = 64
#: Steps that move all prefixes, or all texts, do so in so many passes; a pass's shuffle files go before the next is made.
PASSES = 4
#: Seeds of the orders after the first.
ORDER_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Rounds in which a node meets one centre go on while a round links more than this share of the nodes, up to a number of rounds.
LEAST_LINKED, MOST_ROUNDS = 0.01, 8

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _hashed(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` words."""
    n = max(0, len(words) - width + 1)
    s = np.full(n, width, np.uint64)
    for k in range(width):
        s = _mixed(s * _MUL + words[k : n + k])
    return s


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles.

    ``bytes.lower`` and ``bytes.split`` change and split at exactly the letters
    A-Z and the white space that the definition names.
    """
    words = [t.encode().lower().split() for t in texts]
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(words)), np.uint64, sum(map(len, words)))
    runs, sets, at = _hashed(hashes, WORDS), [], 0
    for n in map(len, words):  # runs that cross texts are left out
        sets.append(np.unique(runs[at : at + n - WORDS + 1]) if n >= WORDS else _hashed(hashes[at : at + n], n) if n else runs[:0])
        at += n
    return sets


def shingles(text: str) -> np.ndarray:
    return shingle_sets([text])[0]


def prefix_length(n: int) -> int:
    """Tokens of an n-set among which any partner's prefix must meet it."""
    return n - -(-n * NUMERATOR // DENOMINATOR) + 1


def least_shared(a: int, b: int) -> int:
    """Tokens that the prefixes of two linked sets of these sizes share at least.

    Linked sets share at least o = 0.8 (a + b) / 1.8 tokens. The k-th of these has
    at most a - o tokens of the first set's own before it, so it lies in that set's
    prefix while k + a - o is at most the prefix's length, and likewise in the other.
    """
    o = -(-NUMERATOR * (a + b) // (NUMERATOR + DENOMINATOR))
    return max(1, o - -(-NUMERATOR * max(a, b) // DENOMINATOR) + 1)


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(44)).astype(np.int64)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the partition's tokens by cell, in slices."""
    counts = np.zeros(CELLS, np.int64)
    for batch in batches:
        for run in slices(batch.column(0).to_pylist()):
            counts += np.bincount(_cells(np.concatenate(shingle_sets(run))), minlength=CELLS)
    width = CELLS // _SLICES
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(_SLICES), pa.int32()), pa.array([counts[i * width : (i + 1) * width].astype("<i4").tobytes() for i in range(_SLICES)], pa.binary())],
        names=["slice", "counts"],
    )


def _summed(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes (powers of two) of a slice's summed counts."""
    total = np.zeros(CELLS // _SLICES, np.int64)
    for batch in batches:
        for part in batch.column("counts").to_pylist():
            total += np.frombuffer(part, "<i4")
    classes = np.log2(np.maximum(total, 1)).astype(np.uint8)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([classes.tobytes()], pa.binary())], names=["slice", "classes"])


def token_classes(docs: DataFrame) -> bytes:
    """The count class of each cell over all documents; CELLS bytes, whatever the data."""
    parts = docs.select(text_or_empty().alias("text")).mapInArrow(_tally, "slice int, counts binary")
    rows = parts.groupBy("slice").applyInArrow(_summed, "slice int, classes binary").collect()  # _SLICES rows of fixed size
    by = {r["slice"]: bytes(r["classes"]) for r in rows}
    return b"".join(by.get(i, bytes(CELLS // _SLICES)) for i in range(_SLICES))


def _prefixes(sets: list[np.ndarray], classes: np.ndarray, seed: int) -> list[np.ndarray]:
    """Prefixes, sorted, under an order: by class, then by a hash of the order's own, then by the tokens themselves."""
    tokens = np.concatenate([*sets, np.empty(0, np.uint64)])
    rank = _mixed(tokens ^ np.uint64(seed)) >> np.uint64(8) | classes[_cells(tokens)].astype(np.uint64) << np.uint64(56)
    out, at = [], 0
    for s in sets:
        out.append(s[np.argsort(rank[at : at + len(s)], kind="stable")[: prefix_length(len(s))]] if len(s) else s)
        at += len(s)
    return out


def _arrays(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*parts, np.empty(0, np.uint64)]).view(np.int64)))


_PROFILE = "n int, sig binary, central int, prefix array<bigint>, packed binary"


def _profiles(classes: bytes):
    """Per document: the set's size and digest, how common its tokens are, its first prefix, and the text compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, press = np.frombuffer(classes, np.uint8), zstandard.ZstdCompressor(level=3)
        for batch in batches:
            done = 0
            for texts in slices(batch.column(1).to_pylist()):
                sets = shingle_sets(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(done, len(texts)), pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([int(1000 * table[_cells(s)].mean()) if len(s) else 0 for s in sets], pa.int32()),
                        _arrays(_prefixes(sets, table, 0)), pa.array([press.compress(t.encode()) for t in texts], pa.binary()),
                    ],
                    names=["doc_id", "n", "sig", "central", "prefix", "packed"],
                )
                done += len(texts)

    return run


_HELD = "node bigint, packed binary, prefixes array<array<int>>"


def _halves(prefixes: list[np.ndarray]) -> pa.ListArray:
    """The lower halves of the tokens of each prefix; null for a prefix in which two of these are equal.

    Other prefixes share at least as many halves as tokens, so a count of halves loses no pair.
    """
    halves = [p.astype(np.uint32).view(np.int32) for p in prefixes]
    lost = np.array([len(np.unique(h)) < len(h) for h in halves], bool)
    ends = np.cumsum([0, *map(len, halves)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*halves, np.empty(0, np.int32)])), mask=pa.array(lost))


def _held(classes: bytes):
    """Per node its prefixes under the other orders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, unpress = np.frombuffer(classes, np.uint8), zstandard.ZstdDecompressor()
        for batch in batches:
            found: list[np.ndarray] = []
            for texts in slices([unpress.decompress(b).decode() for b in batch.column("packed").to_pylist()]):
                sets = shingle_sets(texts)
                found += chain.from_iterable(zip(*(_prefixes(sets, table, seed) for seed in ORDER_SEEDS), strict=True))
            both = pa.ListArray.from_arrays(pa.array(range(0, len(found) + 1, len(ORDER_SEEDS)), pa.int32()), _halves(found))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("packed"), both], names=["node", "packed", "prefixes"])

    return run


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())


def similar(a: np.ndarray, b: np.ndarray) -> tuple[bool, float]:
    """Whether two sets link, and their Jaccard similarity."""
    i = _common(a, b)
    union = len(a) + len(b) - i
    return DENOMINATOR * i >= NUMERATOR * union, i / union


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among pairs of compressed texts; the last few sets that a worker has made serve the pairs of one centre."""
    unpress = zstandard.ZstdDecompressor()

    @lru_cache(maxsize=64)
    def tokens(packed: bytes) -> np.ndarray:
        return shingles(unpress.decompress(packed).decode())

    for batch in batches:
        kept, score = [], []
        for k, (x, y) in enumerate(zip(batch.column("packed_a").to_pylist(), batch.column("packed_b").to_pylist(), strict=True)):
            linked, jaccard = similar(tokens(x), tokens(y))
            if linked:
                kept.append(k)
                score.append(jaccard)
        picked = batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))
        yield pa.RecordBatch.from_arrays([picked.column(0), picked.column(1), pa.array(score, pa.float64())], names=["a", "b", "jaccard"])


def _needed(a: str, b: str) -> str:
    """Tokens that linked sets of these sizes share at least."""
    return f"(({NUMERATOR}L * ({a} + {b}) + {NUMERATOR + DENOMINATOR - 1}) div {NUMERATOR + DENOMINATOR})"


def _meets(x: str, y: str) -> str:
    """Whether a token in two sets can be the first that they share, if they are linked; it implies the length filter."""
    return f"{x}.at <= {x}.n - {_needed(f'{x}.n', f'{y}.n')} and {y}.at <= {y}.n - {_needed(f'{x}.n', f'{y}.n')}"


#: Whether a token can be the first that a set shares with one of its size or larger.
_EARLY = f"at <= n - {_needed('n', 'n')}"


def _enough(shared: str, a: str, b: str) -> str:
    """The count filter: see :func:`least_shared`."""
    return f"{shared} >= {_needed(a, b)} - ({NUMERATOR}L * greatest({a}, {b}) + {DENOMINATOR - 1}) div {DENOMINATOR} + 1"


def _ordered(x: str, nx: str, y: str, ny: str) -> list[Column]:
    """Two nodes with their sizes as ``a, b, na, nb``, the lesser node first."""
    first = F.col(x) < F.col(y)
    return [F.when(first, F.col(p)).otherwise(F.col(q)).alias(name) for name, p, q in (("a", x, y), ("b", y, x), ("na", nx, ny), ("nb", ny, nx))]


def _links(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """The links among candidates ``(a, b, na, nb)``: those that meet under the other orders, and then in their texts."""
    sides = [held.select(F.col("node").alias(s), F.col("prefixes").alias(f"prefixes_{s}")) for s in ("a", "b")]
    met = pairs.join(sides[0], "a").join(sides[1], "b")
    for k in range(len(ORDER_SEEDS)):
        met = met.where(f"prefixes_a[{k}] is null or prefixes_b[{k}] is null or {_enough(f'size(array_intersect(prefixes_a[{k}], prefixes_b[{k}]))', 'na', 'nb')}")
    texts = [held.select(F.col("node").alias(s), F.col("packed").alias(f"packed_{s}")) for s in ("a", "b")]
    return met.select("a", "b").join(texts[0], "a").join(texts[1], "b").mapInArrow(_verify, "a bigint, b bigint, jaccard double")


def _untried(pairs: DataFrame, tried: list[DataFrame]) -> DataFrame:
    return reduce(lambda left, done: left.join(done, ["a", "b"], "left_anti"), tried, pairs)


def _useful(index: DataFrame) -> DataFrame:
    """The index without lists that lie in one component or that no smaller set of a pair has early."""
    lists = index.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.bool_or(F.expr(_EARLY)).alias("early"))
    return index.join(lists.where("lo <> hi and early").select("token"), "token")


def _in_passes(spark: SparkSession, rows: Callable[[Column], DataFrame], key: str, keep: Callable[[DataFrame, str], DataFrame], name: str) -> DataFrame:
    """A table written in passes: ``rows`` of those whose ``key`` meets a condition, for each share of the keys."""
    parts = []
    for k in range(PASSES):
        parts.append(keep(rows(F.pmod(key, F.lit(PASSES)) == k), name))
        drop_shuffles(spark)
    return reduce(DataFrame.unionByName, parts)


def _index(of_nodes: DataFrame, share: Column) -> DataFrame:
    """The posting lists of a share of the tokens: those with several nodes, one of which has the token early."""
    tokens = of_nodes.select("node", "n", F.posexplode("prefix").alias("at", "token")).where(share)
    lists = tokens.groupBy("token").agg(F.count("*").alias("df"), F.bool_or(F.expr(_EARLY)).alias("early"))
    hits = tokens.drop("n").join(lists.where("df > 1 and early").select("token"), "token")
    return hits.join(of_nodes.select("node", "n", "central"), "node").withColumn("label", F.col("node"))


def link_components(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, n_verified)`` of every document.

    ``n_verified`` counts the links of the document's set that were compared:
    links inside a component that were never needed are not among them.
    """
    spark = docs.sparkSession
    texts = docs.select(id_of(docs), text_or_empty().alias("text"))
    classes = token_classes(texts)
    with scratch(spark, "neardup") as keep:
        with scratch(spark, "profiles") as keep_profiles:
            rows = texts.mapInArrow(_profiles(classes), f"doc_id {id_kind(docs)}, {_PROFILE}").withColumn("row", F.monotonically_increasing_id())
            profiles = keep_profiles(rows, "profiles")  # a row's number is settled once written
            nodes = profiles.where("n > 0").groupBy("sig").agg(F.min("row").alias("node"), F.min("doc_id").alias("least_id"))
            nodes = keep(nodes, "nodes")
            members = keep(profiles.select("doc_id", "n", "sig").join(nodes.select("sig", "node"), "sig", "left").drop("sig"), "members")
            with scratch(spark, "prefixes") as keep_prefixes:
                of_nodes = profiles.select(F.col("row").alias("node"), "n", "central", "prefix").join(nodes.select("node"), "node")
                of_nodes = keep_prefixes(of_nodes, "prefixes")
                drop_shuffles(spark)
                index = _in_passes(spark, lambda share: _index(of_nodes, share), "token", keep, "index")
            listed = keep(index.select("node").distinct(), "listed")
            packed = profiles.select(F.col("row").alias("node"), "packed")
            named = lambda share: packed.where(share).join(listed.where(share), "node", "left_semi")
            held = _in_passes(spark, lambda share: named(share).mapInArrow(_held(classes), _HELD), "node", keep, "held")

        links: list[DataFrame] = []
        tried: list[DataFrame] = []
        for turn in range(MOST_ROUNDS):
            # the first centre is the member with the commonest tokens, later ones go by a hash
            rank = F.struct(F.col("central").cast("bigint"), "node") if turn == 0 else F.struct(F.xxhash64(F.lit(turn), "node"), "node")
            centres = index.groupBy("token").agg(F.max_by(F.struct("node", "n", "label", "at"), rank).alias("c"))
            stars = index.alias("x").join(centres, "token").where("x.label <> c.label").where(_meets("x", "c"))
            # of the centres of its lists a node tries the one that it shares most of them with
            votes = stars.groupBy("x.node", F.col("c.node").alias("centre"), "x.n", F.col("c.n").alias("centre_n")).agg(F.count("*").alias("m"))
            votes = votes.select("m", "node", *_ordered("node", "n", "centre", "centre_n"))
            votes = _untried(votes, tried)
            best = votes.groupBy("node").agg(F.max_by(F.struct("a", "b", "na", "nb"), F.struct("m", "a", "b")).alias("p"))
            stars = keep(best.select("p.*").distinct(), "stars")
            tried.append(stars.select("a", "b"))
            links.append(keep(_links(stars, held), "links"))
            parts = connected_components(reduce(DataFrame.unionByName, links), keep)
            labels = index.drop("label").join(parts, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
            index = keep(_useful(labels), "index")
            drop_shuffles(spark)
            if links[-1].count() <= LEAST_LINKED * held.count():
                break
        # x is the larger set of a pair
        pairs = index.alias("x").join(index.where(_EARLY).alias("y"), "token").where("x.label <> y.label").where(_meets("x", "y"))
        pairs = pairs.where("y.n < x.n or y.n = x.n and y.node < x.node")
        pairs = _untried(pairs.select(*_ordered("x.node", "x.n", "y.node", "y.n")).distinct(), tried)
        links.append(keep(_links(pairs, held), "links"))
        found = reduce(DataFrame.unionByName, links)
        parts = connected_components(found, keep)

        degree = found.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_verified"))
        grouped = nodes.join(parts, "node", "left").join(degree, "node", "left")
        grouped = grouped.withColumn("component", F.coalesce("component", "node"))
        least = grouped.groupBy("component").agg(F.min("least_id").alias("component_id"))
        grouped = grouped.join(least, "component").select("node", "component_id", "n_verified")
        out = members.join(grouped, "node", "left")
        return materialize(
            out.select(
                "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                F.coalesce("n_verified", F.lit(0)).cast("long").alias("n_verified"),
            ),
            "groups",
        )
