"""Runs: stretches of words that repeat with a period, found by minimizers of several scales.

A run is a stretch of consecutive words with smallest period q and at least
``max(6, 4 q)`` words that no neighbouring word extends keeping the period.

* Periods of at most SHORT words: a text is compared with itself, shifted by each
  of them.
* Longer ones by scales, each of which serves periods in ``(low, 1.5 low]``. A gram
  is 1.5 times the scale's longest period, so two equal grams inside a run lie whole
  periods apart (a smaller distance would give the run a smaller period), and a run
  has room for a window of grams and the same window one period on. The least gram
  of the first is the least of the second; neighbours among equal window minima
  seed a run, which is then extended word by word in both directions.

Words are numbers that a task gives out, so extension is exact. Grams are 64-bit
hashes, built by doubling; a collision could only hide a seed, with a probability of
about n^2 / 2^64 for a text of n words. Texts of a batch are scanned together, held
apart by numbers that occur once.

Everything is local to a document's row: there is no exchange, and a task holds one
batch of texts, a longer text alone.

Defined cases: a null text has no words; a null id is kept, and no repetition is
planted in it; repeated rows are answered once each; an empty table gives an empty
result; of runs of one exponent the first, then that of the smaller period is named;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relievo.llm.tokens import slices
from relievo.plans.text import text_or_empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LEAST_WORDS, LEAST_EXPONENT = 6, 4
#: Periods up to here are compared directly.
SHORT = 8
#: Characters of the texts that are scanned together.
_TOGETHER = 2 << 20
_PLACE = np.uint64(0xFFFFFFFF)


def _mixed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A hash of pairs of hashes."""
    z = (x * np.uint64(0x9E3779B97F4A7C15)) ^ (y + np.uint64(0xD1B54A32D192ED03))
    z ^= z >> np.uint64(29)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(32)
    return z


def _window_minima(grams: np.ndarray, width: int) -> np.ndarray:
    """Ascending places of the leftmost least gram of every window."""
    least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    places = (least & _PLACE).astype(np.int64)
    return places[np.flatnonzero(np.diff(places, prepend=-1))]


def _reach(a: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from ``at`` on, in one direction, equal those ``lag`` further on."""
    size, n = 64, 0
    while True:
        if step > 0:
            x = a[at + n : at + n + size]
            y = a[at + n + lag : at + n + lag + size]
            same = x[: len(y)] == y
        else:
            low = max(0, at + 1 - n - size)
            same = (a[low : at + 1 - n] == a[low + lag : at + 1 - n + lag])[::-1]
        if not len(same):
            return n
        if not same.all():
            return n + int(np.argmin(same))
        n += len(same)
        size *= 2


def _short_runs(a: np.ndarray, period: int) -> Iterator[tuple[int, int]]:
    """``(start, length)`` of the stretches with this period."""
    at = np.flatnonzero(a[period:] == a[:-period])
    if not len(at):
        return
    first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    size = np.diff(first, append=len(at)) + period
    for k in np.flatnonzero(size >= max(LEAST_WORDS, LEAST_EXPONENT * period)):
        yield int(at[first[k]]), int(size[k])


def _seeds(grams: np.ndarray, low: int, high: int, width: int) -> np.ndarray:
    """Rows ``(distance, place)``: equal window minima whose distance is a period of the scale."""
    places = _window_minima(grams, width)
    value = grams[places]
    order = np.argsort(value, kind="stable")
    value, places = value[order], places[order]
    apart = np.diff(places)
    good = np.flatnonzero((value[1:] == value[:-1]) & (apart > low) & (apart <= high))
    found = np.stack([apart[good], places[good]], axis=1)
    return found[np.lexsort((found[:, 1], found[:, 0]))]


def runs_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """The runs ``(start, length, period)`` of each text of word numbers (not negative), by start and period."""
    found: list[dict[tuple[int, int], int]] = [{} for _ in texts]
    which = np.arange(len(texts))
    size = np.array([len(t) for t in texts], np.int64)
    a = np.concatenate([np.append(t, -1 - i) for i, t in enumerate(texts)]) if texts else np.zeros(0, np.int64)

    def keep(start: int, length: int, period: int) -> None:
        k = int(np.searchsorted(begins, start, "right")) - 1
        found[which[k]].setdefault((start - int(begins[k]), length), period)  # the smallest period comes first

    begins = np.cumsum(size + 1) - size - 1
    for period in range(1, min(SHORT, int(size.max(initial=0))) + 1):
        for start, length in _short_runs(a, period):
            keep(start, length, period)
    low, power, level = SHORT, 1, _mixed(a.astype(np.uint64), np.uint64(0))
    while LEAST_EXPONENT * (low + 1) <= size.max(initial=0):
        stay = size >= LEAST_EXPONENT * (low + 1)
        if not stay.all():
            words = np.repeat(stay, size + 1)
            a, level = a[words], level[words[: len(level)]]
            which, size = which[stay], size[stay]
            begins = np.cumsum(size + 1) - size - 1
        high = low + low // 2
        gram = -(-3 * high // 2)
        while 2 * power <= gram:
            level = _mixed(level[:-power], level[power:])
            power *= 2
        grams = _mixed(level[: len(level) - (gram - power)], level[gram - power :])
        last, end = 0, 0
        for lag, at in _seeds(grams, low, high, 3 * (low + 1) - gram + 1).tolist():
            if lag == last and at < end:
                continue  # inside the stretch just extended
            last, end = lag, at + _reach(a, at, lag, 1)
            start = at - _reach(a, at - 1, lag, -1)
            length = end + lag - start
            if length >= LEAST_EXPONENT * lag:
                keep(start, length, lag)
        low = high
    return [sorted((s, n, p) for (s, n), p in f.items()) for f in found]


def planted(words: list[str], doc_id: int | None) -> list[str]:
    """The words, of which one document in ten, by its id, repeats a stretch from some place to its end."""
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def kept_words(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words outside of what runs hold after their first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [w for w, k in zip(words, np.cumsum(edge[:-1]).tolist(), strict=True) if not k]


def highest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length for its period; runs come by start and period."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


_OUT = "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
_OUT_ARROW = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _OUT.split(", ")])


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = iter(batch.column("doc_id").to_pylist())
        for part in slices(batch.column("text").to_pylist(), _TOGETHER):
            number: dict[str, int] = {}
            held = [(i, planted(WORD.findall(t), i)) for t, i in zip(part, ids)]
            numbers = [np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)) for _, words in held]
            rows = []
            for (i, words), runs in zip(held, runs_of(numbers), strict=True):
                best = highest(runs)
                top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
                rows.append((i, len(runs), *top, _sha(listed), _sha(" ".join(kept_words(words, runs)))))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _OUT_ARROW, strict=True)], schema=_OUT_ARROW)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """The runs of every document, with those that :func:`planted` makes: their number, the highest, digests of all and of what is left."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return texts.mapInArrow(_scan, _OUT)
