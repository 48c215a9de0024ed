"""The prefix trie against a trie of plain Python lists."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np

from relievo.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string, n int, kind string"


def brute(rows):
    convs: dict = {}
    for c, t, role, text, *_ in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(v)] for c, v in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - int(np.fmod(c, 5)), [])[:h] + own[c][h:])
    nodes: dict = {}
    for c, t in built.items():
        for d in range(len(t) + 1):
            nodes.setdefault(t[:d], []).append(c)
    kids: dict = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[k] for k in below) or 1
        saved[p] = sum(saved[k] for k in below) + ((len(nodes[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    ends = lambda p: hashlib.sha256(",".join(map(str, sorted(c for c in nodes[p] if len(built[c]) == len(p)))).encode()).hexdigest()
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else -1, len(m), len(kids.get(p, [])), leaves[p], saved[p], ends(p)) for p, m in nodes.items())


def got(turns):
    return sorted(tuple(-1 if v is None else v for v in r) for r in prefixes.prefix_trie(turns).collect())


def check(spark, rows):
    turns = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA)
    assert got(turns) == brute(rows)


def some(seed, n, words="ab", longest=14):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(3 * n), n):
        for k in range(r.randrange(1, longest)):
            rows.append((c, k, r.choice(["user", "assistant", None]), r.choice([None, "", *words, "é" * 3, "word " * 9])))
    return rows


def test_trees_of_common_and_rare_turns(spark):
    check(spark, some(1, 120))
    check(spark, [(c, t, role, f"{x}{c if t and t > 2 else ''}") for c, t, role, x in some(2, 150, "abcdefgh")])


def test_cases(spark):
    rows = [(c, k, "user", f"t{k}") for c in range(10, 90) for k in range(12)]  # copies
    rows += [(c, 0, "system", "same") for c in range(100, 140)] + [(c, 1, "user", f"own {c}") for c in range(100, 140)]
    rows += [(200, None, None, None), (200, None, "b", "x"), (200, 3, "u", "x"), (200, 3, "u", "x"), (200, 3, "t", "y")] * 2
    rows += [(None, 1, "u", "lost"), (-7, 0, "u", "neg"), (-5, 0, "v", "base"), (-5, 1, "v", "more"), (-2, 0, "w", "near"), (0, 0, "w", "zero"), (0, 1, "w", "one")]
    rows += [(c, 0, "u", "short") for c in range(301, 340) if c % 5]  # no base: many are left without a turn
    rows += [(400, k, "u", "x" * 5000 if k == 3 else "y") for k in range(30)]
    check(spark, rows)


def test_a_long_conversation_crosses_blocks(spark, monkeypatch):
    rows = [(5, k, "u", f"m{k % 7}") for k in range(1300)] + [(10, k, "u", f"m{k % 7}") for k in range(1290)] + [(11, k, "u", "q") for k in range(4)]
    check(spark, rows)
    monkeypatch.setattr(prefixes, "BLOCK", 4)
    check(spark, some(4, 60))


def test_a_full_sketch_changes_nothing(spark, monkeypatch):
    rows = some(6, 90, "abcdefgh")
    monkeypatch.setattr(prefixes, "LEAST_CELLS", 64)
    monkeypatch.setattr(prefixes, "MOST_CELLS", 64)
    monkeypatch.setattr(prefixes, "_BLOCK_CELLS", 8)
    check(spark, rows)


def test_an_estimate_of_one_is_one(spark):
    r = random.Random(3)
    values = [(r.randrange(-(2**63), 2**63), r.randrange(-(2**63), 2**63)) for _ in range(30000)]
    values += values[:9000]
    frame = spark.createDataFrame(values, "x1 long, x2 long").repartition(7)
    ones = prefixes.screen(frame, 1 << 18)
    x = np.array(values, np.int64)
    one = prefixes.proven(ones, x[:, 0], x[:, 1])
    assert not one[:9000].any() and not one[30000:].any() and one[9000:30000].mean() > 0.9


def test_empty(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(None, 1, "u", "x", 1, "z")], SCHEMA)) == []
