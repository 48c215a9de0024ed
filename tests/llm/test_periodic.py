"""Periodic runs against the definition, tried on every stretch."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from relievo.llm import periodic
from tests.llm.fixtures import documents


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if all(w[i] == w[i + q] for i in range(len(w) - q)))


def brute(words):
    """All runs by definition: for each period the stretches that cannot grow, whose smallest period it is."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            if e > s and e - s + q >= max(6, 4 * q) and smallest_period(words[s : e + q]) == q:
                out.append((s, e - s + q, q))
            s = e + 1
    return sorted(out)


def numbered(words):
    known = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


def mixed(r, n, letters):
    """Words with stretches that repeat, some inside each other."""
    out = []
    while len(out) < n:
        p = r.choice([1, 2, 3, 5, 8, 9, 10, 11, 12, 13, 17, 18, 19, 27, 28, 40, 60])
        base = [r.choice(letters) for _ in range(p)]
        if r.random() < 0.3 and p > 6:
            base = base[:2] * 3 + base[6:]
        out += (base * 9)[: int(p * r.choice([0.5, 1, 2, 3.9, 4, 4.1, 6, 8]))]
        out += [r.choice(letters) for _ in range(r.randrange(4))]
    return out[:n]


def test_runs_equal_the_definition():
    r = random.Random(5)
    texts = [mixed(r, r.randrange(1, 700), "ab" if k % 3 == 0 else "abcdefghij") for k in range(60)] + [[], ["a"], ["a"] * 6, ["a"] * 5, ["a", "b"] * 4, ["a"] * 900]
    assert periodic.runs_of([numbered(t) for t in texts]) == [brute(t) for t in texts]
    assert periodic.runs_of([]) == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=45), st.integers(1, 6)), max_size=6))
def test_runs_of_powers(parts):
    words = [w for base, k in parts for w in base * k]
    assert periodic.runs_of([np.array(words, np.int64)]) == [brute(words)]


def test_fibonacci_and_thue_morse_words():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    thue = [bin(i).count("1") % 2 for i in range(1024)]
    for w in (b, thue, thue[:128] * 5 + thue):
        assert periodic.runs_of([np.array(w, np.int64)]) == [brute(w)]


def expected(doc_id, text):
    words = periodic.WORD.findall(text or "")
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_documents(spark):
    r = random.Random(8)
    planted = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(i, " ".join(mixed(r, r.randrange(1, 300), "abcdef")), "en", "s", 1, 1, "k", "s", "l") for i in planted + list(range(300, 330))]
    rows += [(400, "a a " * 8 + "\x1c", None, None, None, None, None, None, None), (401, "x " * 70000 + "y", "en", "s", 1, 1, "k", "s", "l")]
    rows += [(i, None, "en", "s", 1, 1, "k", "s", "l") for i in (planted[0], 402, None)] + [(planted[1], "", "en", "s", 1, 1, "k", "s", "l")]
    rows += [(None, "a b " * 9, "en", "s", 1, 1, "k", "s", "l")] * 2
    got = [tuple(x) for x in periodic.periodic_runs(documents(spark, rows)).collect()]
    long = next(x for x in got if x[0] == 401)
    assert long[1:6] == (1, 0, 70000, 1, 70_000_000)
    assert sorted((x for x in got if x[0] != 401), key=repr) == sorted((expected(x[0], x[1]) for x in rows if x[0] != 401), key=repr)
    assert periodic.periodic_runs(documents(spark).limit(0)).count() == 0


def test_ties_name_the_first_run():
    words = ["a"] * 6 + ["x"] + ["b"] * 6
    assert periodic.highest(brute(words)) == (0, 6, 1)
    assert periodic.kept_words(list("abababab") + ["c"], [(0, 8, 2)]) == ["a", "b", "c"]
