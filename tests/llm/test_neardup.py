from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pytest

from relievo.llm import neardup
from relievo.plans.storage import work_uri
from tests.llm.fixtures import documents, edited, prose


def words(text):
    out, run = [], []
    for c in text:
        if c in " \t\n\x0b\x0c\r":
            if run:
                out.append("".join(run))
            run = []
        else:
            run.append(chr(ord(c) + 32) if "A" <= c <= "Z" else c)
    return [*out, "".join(run)] if run else out


def shingle_set(text):
    w = words(text or "")
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Component by row, from all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= 80 * (len(sets[a]) + len(sets[b]) - i):
                up[find(a)] = find(b)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(k)] = min(least.get(find(k), doc), doc)
    # rows of one id are one document only where their sets are equal
    return [(doc, len(s), least.get(find(k)) if s else doc) for k, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))]


def check(spark, rows):
    docs = documents(spark, [(i, t, "en", "s", 0, 0, "", "", "") for i, t in rows])
    got = sorted((tuple(r) for r in neardup.link_components(docs).select("doc_id", "n_shingles", "component_id").collect()), key=repr)
    assert got == sorted(brute(rows), key=repr)


def test_every_case(spark):
    check(spark, [(r["doc_id"], r["text"]) for r in documents(spark).collect()])
    assert neardup.link_components(documents(spark).limit(0)).count() == 0


def test_a_large_group_of_near_copies_and_a_common_passage(spark):
    r = random.Random(5)
    base, passage = prose(50, 200), prose(51, 60)
    rows = [(k, edited(base, 100 + k, r.choice([0.005, 0.01, 0.02, 0.03]))) for k in range(150)]
    rows += [(1000 + k, f"{prose(2000 + k, r.randrange(5, 150))} {passage} {prose(9000 + k, r.randrange(1, 30))}") for k in range(150)]
    check(spark, rows)


def test_stars_and_pairs_find_the_same(spark, monkeypatch):
    rows = [(k, edited(prose(60 + k % 4, 80), 300 + k, 0.02)) for k in range(60)]
    check(spark, rows)
    monkeypatch.setattr(neardup, "MOST_ROUNDS", 0)
    check(spark, rows)


def test_threshold_is_met_exactly():
    a = np.arange(90, dtype=np.uint64)
    b = np.concatenate([np.arange(80, dtype=np.uint64), np.arange(1000, 1010, dtype=np.uint64)])
    assert neardup.similar(a, b) == (True, pytest.approx(0.8))
    assert not neardup.similar(a, b[1:])[0]


@pytest.mark.parametrize("n", range(1, 60))
def test_prefixes_of_similar_sets_meet_under_every_order(n):
    r = np.random.default_rng(n)
    classes = r.integers(0, 9, neardup.CELLS).astype(np.uint8)
    a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
    drop = r.permutation(len(a))[: len(a) // 9]
    b = np.unique(np.concatenate([np.delete(a, drop), r.integers(0, 2**63, len(drop)).astype(np.uint64)]))
    if neardup.similar(a, b)[0]:
        for seed in (0, *neardup.ORDER_SEEDS):
            pa, pb = (p.tolist() for p in neardup._prefixes([a, b], classes, seed))
            shared = [t for t in pa if t in pb]
            assert len(shared) >= neardup.least_shared(len(a), len(b))
            needed = -(-neardup.NUMERATOR * (len(a) + len(b)) // (neardup.NUMERATOR + neardup.DENOMINATOR))
            assert pa.index(shared[0]) <= len(a) - needed and pb.index(shared[0]) <= len(b) - needed


def test_two_thousand_rows_without_an_id(spark):
    """Pairs of near copies, none with an id: each pair is one comparison."""
    rows = [(None, t) for k in range(1000) for base in [prose(40_000 + k, 40)] for t in (base, f"{base} end")]
    out = neardup.link_components(documents(spark, [(i, t, "en", "s", 0, 0, "", "", "") for i, t in rows])).groupBy("component_id", "n_verified").count()
    assert [tuple(r) for r in out.collect()] == [(None, 1, 2000)]


def test_prefixes_and_texts_move_in_passes(spark, monkeypatch):
    root = Path(work_uri(spark).removeprefix("file://")) / "relievo"
    seen, before = [], set(root.glob("*"))
    tables = lambda: [p.name.rsplit("-", 1)[0] for d in set(root.glob("*")) - before for p in d.glob("*-*")]
    monkeypatch.setattr(neardup, "drop_shuffles", lambda s: seen.append(tables()))
    check(spark, [(r["doc_id"], r["text"]) for r in documents(spark).collect()])
    # a pass's table is there, and its shuffle files go, before the next pass
    for name in ("index", "held"):
        assert {t.count(name) for t in seen} >= set(range(1, neardup.PASSES + 1))
    # the prefixes are gone before texts move
    assert not any("prefixes" in t and "held" in t for t in seen)


def test_halves_count_no_less_than_tokens():
    tokens = np.array([5, 5 + (1 << 32), 7], np.uint64)
    assert neardup._halves([tokens[:1], tokens, tokens[:0], tokens[1:]]).to_pylist() == [[5], None, [], [5, 7]]
