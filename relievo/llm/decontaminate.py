"""Benchmark decontamination: BM25 over test items with block-max WAND.

The test items are the indexed documents, every passage of every training text is
a query. Impacts are scaled by an item's score against itself, so one threshold
holds for all items. Block-max WAND over the item postings retrieves every item at
or above the threshold. A retrieved item counts when enough of the word n-grams of
its question and of its answer both occur in the passage; the answer is an item's
last sentence, or the last third of its words.

Items are indexed by classes of length, powers of two of their words. A class has
passages of its own: they are twice as long as the class's longest items may be and
overlap by half, so an item that was copied as a whole lies within one passage as a
whole, and what is found of an item depends on that item alone.

Block maxima serve twice. Before WAND, a run of passages is tested at once: for
each span of SPAN items the greatest impacts of a passage's terms are added up; passages in which no
span can reach the threshold end there, and WAND skips to the spans that can. The commonest terms
of the items stay out of this test as long as they make up at most COMMON of any
item; a span's greatest share of them is added instead.

The index is cut by a hash into shards of about SHARD_ITEMS items or SHARD_WORDS words. Tasks
build them, each in a file of the shared folder; the driver holds their names. Documents are read
once: a task gathers a run of texts of RUN characters and takes it through one shard after
the other, of which it holds one at a time (some 100 MB). The test before WAND goes
over the run's passages in portions of a fixed number of table cells, so what it
holds depends neither on the texts nor on how often items share their words.

Defined cases: null and empty texts match nothing; items without words are left
out; a null id is kept; repeated rows are reported once each; repeated items are
reported as often as they are there; of passages of one text where an item reaches the threshold
that with the greatest overlaps, then score, counts; an empty table on either side
gives an empty result; texts are taken whole, very long ones alone; other columns
are ignored.
"""

from __future__ import annotations

import pickle
import re
import uuid
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relievo.llm.tokens import slices
from relievo.plans.storage import delete, materialize, new_folder
from relievo.plans.text import id_kind, id_of, row_digest, text_or_empty

K1, B = 1.2, 0.75
#: Share of an item's score against itself that a passage has to reach.
THRESHOLD = 0.5
#: Share of the n-grams of the question, and of the answer, that has to occur.
OVERLAP = 0.6
GRAM = 4
#: Most of an item's score that comes from terms set aside.
COMMON = 0.25
BLOCK = 32
#: Items of a span in the test before WAND.
SPAN = 8
#: Words of the shortest class of items.
LEAST_STEP = 8
#: Items, and words, of one shard.
SHARD_ITEMS, SHARD_WORDS = 20_000, 1_000_000
#: Characters of the texts that pass the shards together.
RUN = 16 << 20
#: Table cells of a portion in the test before WAND.
PORTION = 1 << 21

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"[.?!:]\s+|\n+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The words before and of the last sentence, which has two words at least."""
    parts = [w for w in map(words, _SENTENCE.split(text)) if w]
    if len(parts) > 1 and len(parts[-1]) > 1:
        return [x for p in parts[:-1] for x in p], parts[-1]
    flat = [x for p in parts for x in p]
    cut = len(flat) - max(1, len(flat) // 3)
    return flat[:cut], flat[cut:]


def grams(tokens: list[str]) -> set[tuple]:
    n = min(GRAM, len(tokens))
    return {tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1)} if n else set()


def share(part: list[str], passage: list[str]) -> float:
    """Share of the part's n-grams in the passage; 1 for an empty part."""
    wanted = grams(part)
    if not wanted:
        return 1.0
    n = min(GRAM, len(part))
    there = {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)}
    return len(wanted & there) / len(wanted)


@dataclass
class Index:
    """An inverted index of one shard's items of a length class; postings by term are sorted by item and cut into blocks."""

    items: list[int | None]
    times: list[int]  # how often an item is there
    questions: list[list[str]]
    answers: list[list[str]]
    terms: dict[str, int] = field(default_factory=dict)
    postings: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    lists: list[tuple[list, list, list, list]] = field(default_factory=list)  # the postings as lists
    step: int = LEAST_STEP  # words from one passage to the next; a passage has twice as many
    essential: np.ndarray | None = None  # by term, and False for no term
    mass: np.ndarray | None = None  # by span, the greatest of an item's terms set aside
    starts: np.ndarray | None = None  # of each term's spans in the two flat arrays
    spans: np.ndarray | None = None
    impacts: np.ndarray | None = None  # the greatest ones of a term in its spans


def step_of(n_words: int) -> int:
    """The step of the class of items of so many words: the next power of two."""
    return max(LEAST_STEP, 1 << (n_words - 1).bit_length())


def build_indexes(rows: list[tuple], n_items: int, mean_words: float, frequency: dict[str, int]) -> list[Index]:
    """Indexes of a shard's items ``(item_id, text, times)``, one for each class of length."""
    classes: dict[int, list] = {}
    for item, text, *times in rows:
        if n := len(words(text)):
            classes.setdefault(step_of(n), []).append((item, text, *times))
    return [build_index(classes[step], n_items, mean_words, frequency, step) for step in sorted(classes)]


def build_index(rows: list[tuple], n_items: int, mean_words: float, frequency: dict[str, int], step: int = LEAST_STEP) -> Index:
    """Index items under the statistics of all items."""
    index = Index([], [], [], [], step=step)
    lists: dict[str, list[tuple[int, float]]] = {}
    for item, text, *times in rows:
        q, a = question_and_answer(text)
        counts = Counter(q + a)
        if not counts:
            continue
        length = sum(counts.values())
        impact = {
            t: np.log(1 + (n_items - frequency[t] + 0.5) / (frequency[t] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * length / mean_words))
            for t, c in counts.items()
        }
        own = sum(impact.values())
        for t, x in impact.items():
            lists.setdefault(t, []).append((len(index.items), x / own))
        index.items.append(item)
        index.times.append(*(times or [1]))
        index.questions.append(q)
        index.answers.append(a)
    for t, posts in lists.items():
        ids, impacts = np.array([p[0] for p in posts]), np.array([p[1] for p in posts])
        starts = np.arange(0, len(ids), BLOCK)
        index.terms[t] = len(index.postings)
        index.postings.append((ids, impacts, np.maximum.reduceat(impacts, starts), ids[np.minimum(starts + BLOCK, len(ids)) - 1]))
    index.lists = [tuple(x.tolist() for x in p) for p in index.postings]
    spans, greatest = [np.empty(0, np.int64)], [np.empty(0)]
    for ids, impacts, *_ in index.postings:
        span, first = np.unique(ids // SPAN, return_index=True)
        spans.append(span)
        greatest.append(np.maximum.reduceat(impacts, first))
    index.starts = np.cumsum([len(s) for s in spans])
    index.spans, index.impacts = np.concatenate(spans), np.concatenate(greatest)
    index.essential = np.ones(len(index.postings) + 1, bool)
    index.essential[-1] = False
    mass = np.zeros(-(-len(index.items) // SPAN) * SPAN)
    for t in sorted(range(len(index.postings)), key=lambda t: (-len(index.postings[t][0]), t)):
        ids, impacts = index.postings[t][:2]
        if (mass[ids] + impacts).max() <= COMMON:
            mass[ids] += impacts
            index.essential[t] = False
    index.mass = mass.reshape(-1, SPAN).max(axis=1)
    return index


def retrieve(index: Index, terms: list[int], threshold: float, spans: list[int] | None = None) -> list[tuple[int, float]]:
    """Every item whose score for the distinct ``terms`` reaches the threshold, by block-max WAND; with ``spans``, those of these spans of items."""
    slack = threshold - 1e-9
    end = len(index.items)
    # a cursor: the item it is at, its place, the term, and the term's ids, impacts, block maxima, blocks' last ids and greatest impact
    cursors = [[p[0][0], 0, t, *p, max(p[2])] for t in terms for p in (index.lists[t],)]
    found = []

    def advance(c: list, item: int) -> None:
        c[1] = bisect_left(c[3], item, c[1])
        c[0] = c[3][c[1]] if c[1] < len(c[3]) else end

    while True:
        cursors = sorted(c for c in cursors if c[0] < end)
        bound, pivot = 0.0, None
        for i, c in enumerate(cursors):
            bound += c[7]
            if bound >= slack:
                pivot = i
                break
        if pivot is None:
            return found
        item = cursors[pivot][0]
        if spans is not None:
            at = bisect_left(spans, item // SPAN)
            if at == len(spans):
                return found
            if spans[at] * SPAN > item:  # no item before that span can reach the threshold
                for c in cursors[: pivot + 1]:
                    advance(c, spans[at] * SPAN)
                continue
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        first = cursors[: pivot + 1]
        shallow, until = 0.0, end
        for c in first:
            block = bisect_left(c[6], item)
            if block < len(c[5]):
                shallow += c[5][block]
                until = min(until, c[6][block] + 1)
        if shallow < slack:  # no item up to the first block's end can reach it
            if pivot + 1 < len(cursors):
                until = min(until, cursors[pivot + 1][0])
            for c in first:
                advance(c, max(until, item + 1))
        elif cursors[0][0] == item:
            score = 0.0
            for c in first:
                score += c[4][c[1]]
                advance(c, item + 1)
            if score >= slack:
                found.append((item, score))
        else:
            for c in first:
                if c[0] < item:
                    advance(c, item)


_HITS = "item_id bigint, score double, question_overlap double, answer_overlap double"
_HITS_ARROW = [("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())]


def promising(index: Index, ids: np.ndarray, half: np.ndarray, base: np.ndarray, top: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The windows, each with the spans of items that can reach the threshold by the greatest impacts of its terms there.

    For each word of a run of texts, ``ids`` has its term (-1 for none), ``half``
    the half window of its text that it lies in, ``base`` the number of the text's
    first window and ``top`` how many windows the text has.
    """
    at = np.flatnonzero(index.essential[ids])
    term, half, base, top = ids[at], half[at], base[at], top[at]
    here, before = half < top, half > 0  # a half window belongs to the window that begins with it and to the one before
    n_terms, n_spans = len(index.postings), len(index.mass)
    keys = np.concatenate([((base + half) * n_terms + term)[here], ((base + half - 1) * n_terms + term)[before]])
    window, term = np.divmod(np.unique(keys), n_terms)
    size = index.starts[term + 1] - index.starts[term]
    # portions of whole windows, by the rows that their terms' spans make; a window alone may make more
    first = np.flatnonzero(np.diff(window, prepend=-1))
    rows = np.add.reduceat(size, first) if len(first) else first
    portion = np.cumsum(np.minimum(rows, PORTION)) // PORTION
    cuts = np.append(first[np.flatnonzero(np.diff(portion, prepend=-1))], len(term))
    found = [_reaching(index, window[a:b], term[a:b], size[a:b], n_spans, threshold) for a, b in zip(cuts[:-1], cuts[1:])]
    return tuple(np.concatenate([*(f[k] for f in found), np.empty(0, np.int64)]) for k in (0, 1))


def _reaching(index: Index, window: np.ndarray, term: np.ndarray, size: np.ndarray, n_spans: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Those of the windows, given with their terms, in which some span can reach the threshold, with these spans."""
    row = np.repeat(np.arange(len(term)), size)
    place = index.starts[term][row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    names, at = np.unique(window, return_inverse=True)
    if len(names) * n_spans <= 4 * len(row):  # most cells of the table of windows and spans are in use
        bound = np.bincount(at[row] * n_spans + index.spans[place], index.impacts[place], len(names) * n_spans).reshape(-1, n_spans)
        number, span = np.nonzero((bound > 0) & (bound + index.mass >= threshold - 1e-9))
        return names[number], span
    pair, inverse = np.unique(at[row] * n_spans + index.spans[place], return_inverse=True)
    bound = np.bincount(inverse, index.impacts[place], len(pair))
    number, span = np.divmod(pair, n_spans)
    reach = bound + index.mass[span] >= threshold - 1e-9
    return names[number[reach]], span[reach]


def match(indexes: list[Index], texts: list[str], threshold: float, overlap: float) -> list[tuple]:
    """``(text's place, item_id, score, question_overlap, answer_overlap)`` of the items that a run of texts holds."""
    tokens = [words(t) for t in texts]
    return sorted((hit for index in indexes for hit in _hits(index, tokens, threshold, overlap)), key=lambda h: h[0])


def _hits(index: Index, tokens: list[list[str]], threshold: float, overlap: float) -> list[tuple]:
    sizes, step = np.array([len(x) for x in tokens]), index.step
    windows = np.maximum(1, -(-(sizes - step) // step))
    first = np.concatenate([[0], np.cumsum(windows)])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.fromiter(map(index.terms.get, chain.from_iterable(tokens), repeat(-1)), np.int64, int(begin[-1]))
    half = (np.arange(len(ids)) - np.repeat(begin[:-1], sizes)) // step
    pairs, spans = promising(index, ids, half, np.repeat(first[:-1], sizes), np.repeat(windows, sizes), threshold)
    found, ends = np.unique(pairs, return_index=True)
    ends = [*ends.tolist(), len(pairs)]
    best: dict[tuple[int, int], tuple] = {}
    for k, (number, window) in enumerate(zip((np.searchsorted(first, found, "right") - 1).tolist(), found.tolist(), strict=True)):
        start = (window - int(first[number])) * step
        passage = tokens[number][start : start + 2 * step]
        distinct = np.unique(ids[begin[number] + start : begin[number] + start + len(passage)])
        for item, score in retrieve(index, distinct[distinct >= 0].tolist(), threshold, spans[ends[k] : ends[k + 1]].tolist()):
            q, a = share(index.questions[item], passage), share(index.answers[item], passage)
            if q >= overlap and a >= overlap and (q + a, score) > best.get((number, item), (0.0, 0.0)):
                best[number, item] = (q + a, score, q, a)
    return [(number, index.items[item], round(b[1], 6), round(b[2], 6), round(b[3], 6)) for (number, item), b in sorted(best.items()) for _ in range(index.times[item])]


def _write(uri: str, n_items: int, mean_words: float):
    """Builds the shards, which come one after the other, each with a file of its own; their names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(uri)
        store.create_dir(base, recursive=True)
        names, shard, rows, frequency = [], None, [], {}

        def build() -> None:
            if indexes := build_indexes(rows, n_items, mean_words, frequency):
                names.append(f"{uuid.uuid4().hex}.index")
                with store.open_output_stream(f"{base}/{names[-1]}", compression=None) as out:
                    pickle.dump([replace(i, lists=[]) for i in indexes], out, protocol=5)
            rows.clear()
            frequency.clear()

        for batch in batches:
            for number, item, text, n, terms, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != shard:
                    build()
                    shard = number
                rows.append((item, text, n))
                frequency.update(zip(terms, counts, strict=True))
        build()
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names)], names=["file"])

    return run


@lru_cache(maxsize=1)
def _load(uri: str, name: str) -> list[Index]:
    """A shard's indexes from its file; a worker holds the last one."""
    store, base = fs.FileSystem.from_uri(uri)
    with store.open_input_file(f"{base}/{name}") as f:
        indexes = pickle.loads(f.read())
    for index in indexes:
        index.lists = [tuple(x.tolist() for x in p) for p in index.postings]
    return indexes


def _query(uri: str, names: list[str], threshold: float, overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held, kind = [], [], 0, None

        def hits() -> Iterator[pa.RecordBatch]:
            for name in names:
                rows, done = [], 0
                indexes = _load(uri, name)
                for part in slices(texts):
                    rows += [(ids[done + n], *hit) for n, *hit in match(indexes, part, threshold, overlap)]
                    done += len(part)
                if rows:
                    schema = pa.schema([("doc_id", kind), *_HITS_ARROW])
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids.append(doc)
                texts.append(text)
                held += len(text)
                if held >= RUN:
                    yield from hits()
                    ids, texts, held = [], [], 0
        if texts:
            yield from hits()

    return run


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [[w for part in question_and_answer(t) for w in part] for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.string()))], names=["item_id", "text", "times", "words"])


def write_index(benchmark: DataFrame, uri: str, shard_items: int = SHARD_ITEMS, shard_words: int = SHARD_WORDS) -> list[str]:
    """Build the index of all items below ``uri``; the names of its shards."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text")).groupBy("item_id", "text").agg(F.count("*").alias("times"))
    kept = items.mapInArrow(_item_words, "item_id bigint, text string, times bigint, words array<string>").where(F.size("words") > 0)
    size = kept.agg(F.coalesce(F.sum("times"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.size("words") * F.col("times")), F.lit(0)).alias("words")).first()
    if not size["n"]:
        return []
    shards = max(1, -(-size["n"] // shard_items), -(-size["words"] // shard_words))
    key = F.struct("item_id", "text").alias("key")
    terms = kept.select(key, "times", F.explode(F.array_distinct("words")).alias("t"))
    frequency = terms.groupBy("t").agg(F.sum("times").alias("df"))
    told = terms.join(frequency, "t").groupBy("key", "times").agg(F.collect_list("t").alias("terms"), F.collect_list("df").alias("counts"))
    dealt = told.select(F.pmod(F.xxhash64("key.item_id", "key.text"), F.lit(shards)).alias("shard"), "key.item_id", "key.text", "times", "terms", "counts")
    ordered = dealt.repartitionById(int(shards), F.col("shard").cast("int")).sortWithinPartitions("shard", "item_id", "text")
    built = ordered.mapInArrow(_write(uri, size["n"], size["words"] / size["n"]), "file string")
    return sorted(r["file"] for r in materialize(built, "index-files", uri).collect())  # a name for each shard


def contamination(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """``(doc_id, item_id, score, question_overlap, answer_overlap)`` of each item that a text holds."""
    spark = docs.sparkSession
    uri = new_folder(spark, "index")
    try:
        names = write_index(benchmark, uri, shard_items)
        texts = docs.select(id_of(docs), text_or_empty().alias("text"))
        kind = f"doc_id {id_kind(docs)}, {_HITS}"
        return materialize(texts.mapInArrow(_query(uri, names, threshold, overlap), kind), "hits")
    finally:
        delete(spark, uri)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no test item; each row is judged by its id and text."""
    keyed = docs.withColumn("__row", row_digest())
    hits = contamination(docs.select(row_digest().alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("__row")).distinct()
    return keyed.join(hits, "__row", "left_anti").select(*docs.columns)
