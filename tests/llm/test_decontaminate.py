from __future__ import annotations

import math
import random
import tracemalloc
from collections import Counter

import numpy as np

from pyspark.sql import functions as F

from relievo.llm import decontaminate as dc
from tests.llm.fixtures import WORDS, documents, prose


def items_of(n):
    return [(k, f"{prose(700 + k, 12 + k % 20).capitalize()}. Answer {prose(900 + k, 6)}.") for k in range(n)]


def index_of(items):
    sets = [set(dc.words(t)) for _, t in items]
    df = Counter(w for s in sets for w in s)
    mean = sum(len(dc.words(t)) for _, t in items) / len(items)
    return dc.build_index(items, len(items), mean, df)


def test_wand_equals_scoring_everything():
    index = index_of(items_of(150))
    r = random.Random(1)
    names = list(index.terms)
    for threshold in (0.2, 0.5, 0.8):
        for _ in range(60):
            terms = [index.terms[w] for w in r.sample(names, r.randrange(1, 25)) if w in index.terms]
            scores = np.zeros(len(index.items))
            for t in terms:
                ids, impacts, *_ = index.postings[t]
                scores[ids] += impacts
            want = {i: s for i, s in enumerate(scores) if s >= threshold - 1e-9}
            got = dict(dc.retrieve(index, terms, threshold))
            assert set(got) == set(want) and all(abs(got[i] - want[i]) < 1e-9 for i in got)


def test_planted_items_are_found_and_others_left(spark):
    items = items_of(40)
    rows = []
    for k in range(60):
        words = [f"w{random.Random(k * 1000 + j).randrange(10**6)}" if j % 2 else WORDS[j % len(WORDS)] for j in range(300)]
        text = " ".join(words)
        if k % 3 == 0:
            text = f"{text} {items[k % 40][1].upper()} {text}"
        rows.append((k, text, "en", "s", 0, 0, "", "", ""))
    bench = spark.createDataFrame([(*i, "z") for i in items] + [(500, None, "z"), (501, "...", "z")], "item_id long, text string, shard string")
    docs = documents(spark, rows)
    got = {(r["doc_id"], r["item_id"]) for r in dc.contamination(docs, bench).collect()}
    assert got == {(k, k % 40) for k in range(0, 60, 3)}
    assert {r["doc_id"] for r in dc.clean(docs, bench).collect()} == {k for k in range(60) if k % 3}


def test_shards_find_the_same(spark):
    items = items_of(30)
    docs = documents(spark, [(k, f"intro {t} outro", "en", "s", 0, 0, "", "", "") for k, t in items])
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, dc.contamination(docs, bench).collect()))
    assert sorted(map(tuple, dc.contamination(docs, bench, shard_items=7).collect())) == whole and len(whole) >= 30
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    assert sorted((int(r[0][1:]), *r[1:]) for r in dc.contamination(named, bench, shard_items=11).collect()) == whole
    twice = dc.contamination(docs, bench.unionByName(bench.where("item_id < 5"))).collect()
    assert Counter(r["item_id"] for r in twice if r["doc_id"] == r["item_id"])[3] == 2


def test_empty_inputs(spark):
    docs = documents(spark)
    bench = spark.createDataFrame(items_of(3), "item_id long, text string")
    assert dc.contamination(docs, bench.limit(0)).count() == 0
    assert dc.contamination(docs.limit(0), bench).count() == 0
    assert dc.clean(docs, bench.limit(0)).count() == docs.count()


def test_the_answer_is_the_last_sentence():
    assert dc.question_and_answer("What is it? A big stone.") == (["what", "is", "it"], ["a", "big", "stone"])
    q, a = dc.question_and_answer("one two three four five six")
    assert (len(q), len(a)) == (4, 2) and dc.question_and_answer("") == ([], [""][:0])


def brute(items, texts, threshold=dc.THRESHOLD, overlap=dc.OVERLAP):
    """Every item against every passage of every text, by the formulas alone."""
    bags = {k: dc.words(t) for k, (_, t) in enumerate(items) if dc.words(t or "")}
    df = Counter(w for b in bags.values() for w in set(b))
    mean = sum(map(len, bags.values())) / len(bags)

    def impact(w, bag):
        c = bag.count(w)
        return math.log(1 + (len(bags) - df[w] + 0.5) / (df[w] + 0.5)) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(bag) / mean))

    def share(part, passage):
        n = min(4, len(part))
        grams = lambda x: {tuple(x[i : i + n]) for i in range(len(x) - n + 1)}
        return len(grams(part) & grams(passage)) / len(grams(part)) if part else 1.0

    found = []
    for number, text in enumerate(texts):
        tokens = dc.words(text)
        for k, bag in bags.items():
            step = 8
            while step < len(bag):
                step *= 2
            impacts = {w: impact(w, bag) for w in set(bag)}
            best = None
            for start in range(0, max(1, len(tokens) - step), step):
                passage = tokens[start : start + 2 * step]
                score = sum(x for w, x in impacts.items() if w in set(passage)) / sum(impacts.values())
                if score >= threshold - 1e-9:
                    q, a = (share(part, passage) for part in dc.question_and_answer(items[k][1]))
                    if q >= overlap and a >= overlap:
                        best = max(best or (0.0, 0.0, 0.0, 0.0), (q + a, score, q, a), key=lambda b: b[:2])
            if best:
                found.append((number, items[k][0], *(round(v, 6) for v in best[1:])))
    return sorted(found)


def lengthy_items(n):
    """Items of 3 to about 300 words."""
    return [(k, f"{prose(3000 + k, 2 + (k * k) % 290)}. {prose(5000 + k, 1 + k % 9)}.") for k in range(n)]


def spoiled(text, seed, share):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) if r.random() < share else w for w in text.split())


def test_every_passage_against_every_item():
    items = lengthy_items(36)
    texts = [prose(40 + k, 30 * k) for k in range(6)] + ["", "one", *(t for _, t in items[:4])]
    for k, (_, t) in enumerate(items):
        texts.append(f"{prose(60 + k, k * 7)} {spoiled(t, k, 0.02 * (k % 6))} {prose(80 + k, 40)}")
    rows = [(i, t) for i, t in items]
    df = Counter(w for _, t in items for w in set(dc.words(t)))
    mean = sum(len(dc.words(t)) for _, t in items) / len(items)
    indexes = dc.build_indexes(rows, len(items), mean, df)
    got = [(number, item, *rest) for number, item, *rest in dc.match(indexes, texts, dc.THRESHOLD, dc.OVERLAP)]
    want = brute(items, texts)
    assert len(want) > 24 and sorted(got) == want


def test_copies_of_any_length_are_found(spark):
    """Recall by length class: whole copies in running text, at any place."""
    items = lengthy_items(60)
    rows = [(k, f"{prose(100 + k, 13 * k)} {t} {prose(200 + k, 500)}", "en", "s", 0, 0, "", "", "") for k, (_, t) in enumerate(items)]
    got = {(r["doc_id"], r["item_id"]) for r in dc.contamination(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    missed = Counter(dc.step_of(len(dc.words(items[k][1]))) for k in range(60) if (k, k) not in got)
    assert not missed


def test_an_item_is_found_whatever_else_is_indexed(spark):
    item = (1, f"{prose(31, 20)}. {prose(32, 5)}.")
    docs = documents(spark, [(1, f"{prose(33, 300)} {item[1]} {prose(34, 300)}", "en", "s", 0, 0, "", "", "")])
    for others in ([], [(2, prose(35, 400))], [(2, "a b"), (3, prose(36, 900))]):
        bench = spark.createDataFrame([item, *others], "item_id long, text string")
        assert [r["item_id"] for r in dc.contamination(docs, bench).collect()] == [1]


def test_portions_change_nothing(monkeypatch):
    items = lengthy_items(36)
    texts = [f"{prose(60 + k, k * 7)} {spoiled(t, k, 0.02 * (k % 6))} {prose(80 + k, 40)}" for k, (_, t) in enumerate(items)]
    df = Counter(w for _, t in items for w in set(dc.words(t)))
    indexes = dc.build_indexes(items, len(items), sum(len(dc.words(t)) for _, t in items) / len(items), df)
    whole = dc.match(indexes, texts, dc.THRESHOLD, dc.OVERLAP)
    for cells in (1, 50, 3000):
        monkeypatch.setattr(dc, "PORTION", cells)
        assert dc.match(indexes, texts, dc.THRESHOLD, dc.OVERLAP) == whole


def zipf(seed, n, vocabulary):
    r = np.random.default_rng(seed)
    return [f"v{int(x)}" for x in np.minimum(r.zipf(1.3, n), vocabulary)]


def test_many_short_items_that_share_their_words_take_bounded_memory():
    words = zipf(1, 8 * 2000, 3000)
    items = [(k, " ".join(words[8 * k : 8 * k + 8])) for k in range(2000)]
    df = Counter(w for _, t in items for w in set(dc.words(t)))
    indexes = dc.build_indexes(items, len(items), 8.0, df)
    text = " ".join(zipf(2, 2_000, 3000))
    tracemalloc.start()
    hits = dc.match(indexes, [text], dc.THRESHOLD, dc.OVERLAP)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6 and all(score >= dc.THRESHOLD - 1e-6 for _, _, score, *_ in hits)


def test_recall_under_edits():
    """Shares of items of 8 to about 300 words that are found with some of their words replaced."""
    items = [(k, t) for k, t in lengthy_items(100) if len(dc.words(t)) >= 8]
    df = Counter(w for _, t in items for w in set(dc.words(t)))
    indexes = dc.build_indexes(items, len(items), sum(len(dc.words(t)) for _, t in items) / len(items), df)
    found = {}
    for share in (0.0, 0.05, 0.1, 0.2):
        texts = [f"{prose(60 + k, 50)} {spoiled_but_sentence(t, k, share)} {prose(80 + k, 40)}" for k, (_, t) in enumerate(items)]
        hits = {(n, item) for n, item, *_ in dc.match(indexes, texts, dc.THRESHOLD, dc.OVERLAP)}
        found[share] = sum((k, item) in hits for k, (item, _) in enumerate(items)) / len(items)
    print("recall by share of edited words", found)
    assert found[0.0] == 1 and found[0.05] > 0.75 and found[0.1] > 0.4


def spoiled_but_sentence(text, seed, share):
    r = random.Random(seed)
    return " ".join(f"x{r.randrange(10**6)}" if r.random() < share else w for w in text.split())
