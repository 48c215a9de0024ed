"""All stages against plain Python, and rows without an id and ids with several texts in the stages that filter."""

from __future__ import annotations

import math
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from relievo.llm import quality
from relievo.plans.text import row_digest
from tests.llm import test_decontaminate, test_neardup, test_quality, test_secrets
from tests.llm.fixtures import documents, prose
from tests.llm.test_decontaminate import items_of


def told(docs):
    return sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=repr)


def frame(spark, rows):
    return documents(spark, [(i, t, "en", "s", 0, 0, "", "", "") for i, t in rows])


def test_noise_without_an_id_goes(spark, tmp_path):
    spark.createDataFrame([(k, 1, 0) for k in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    noise = " ".join(w + "%&$#" for w in prose(7, 50).upper().split())
    rows = [(k, prose(k, 60 + k)) for k in range(60)] + [(None, prose(0, 60)), (None, noise), (70, prose(0, 60)), (70, noise)]
    out = told(corpus_pipeline.quality_stage(spark, frame(spark, rows), str(tmp_path)))
    assert (None, noise) not in out and (70, noise) not in out and (None, prose(0, 60)) in out and (70, prose(0, 60)) in out


def test_copies_without_an_id_go_and_each_text_of_an_id_stays(spark):
    a, b, c, d = (prose(k, 120) for k in range(4))
    rows = [(None, a), (None, a), (9, a), (3, f"{a} end"), (5, b), (5, c), (5, c), (None, d), (None, f"{d} end")]
    out = told(corpus_pipeline.near_duplicate_stage(spark, frame(spark, rows), ""))
    assert out[:3] == told(frame(spark, [(3, f"{a} end"), (5, b), (5, c)])) and len(out) == 4
    assert out[3][0] is None and out[3][1].startswith(d)


def test_one_contaminated_row_takes_no_other(spark, tmp_path):
    items = items_of(5)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, f"intro {items[0][1]} outro"), (None, prose(3, 50)), (4, items[1][1]), (4, prose(4, 50))]
    out = told(corpus_pipeline.decontamination_stage(spark, frame(spark, rows), str(tmp_path)))
    assert out == told(frame(spark, [(None, prose(3, 50)), (4, prose(4, 50))]))


def redacted(text):
    out, at = "", 0
    for _, a, b in test_secrets.brute(text):
        if a >= at:
            out += text[at:a] + "[secret]"
        at = max(at, b)
    return out + text[at:]


def survivors(spark, rows, trusted_ids, items):
    """``(doc_id, text)`` after four stages in plain Python; only the keys and their halves come from Spark."""
    docs = frame(spark, rows).select("doc_id", "text", row_digest().alias("key"))
    keyed = [(*r, half) for *r, half in docs.selectExpr("doc_id", "text", "key", "pmod(xxhash64(1, key), 2) = 0").collect()]
    trusted = {key: (text, half) for doc, text, key, half in keyed if doc in trusted_ids}
    whole, learnt = test_quality.Model([t for t, _ in trusted.values()]), test_quality.Model([t for t, half in trusted.values() if half])
    score = lambda model, t: -sum(math.log(model.p(g)) for g in test_quality.grams(t)) / (len(t) + 1)
    weight = lambda t: math.sqrt(len(t) / (len(t) + 200))
    unseen = [(score(learnt, t), t) for t, half in trusted.values() if not half]
    mid = sorted(p for p, _ in unseen)[math.ceil(0.5 * len(unseen)) - 1]
    wide = sorted((p - mid) * weight(t) for p, t in unseen)[math.ceil(quality.QUANTILE * len(unseen)) - 1]
    kept = [(doc, text, key) for doc, text, key, _ in keyed if (text or "").strip() and (score(whole, text) - mid) * weight(text) <= wide]
    groups = {}
    for (doc, text, key), (_, _, group) in zip(kept, test_neardup.brute([(k, t) for k, (_, t, _) in enumerate(kept)]), strict=True):
        best = (doc is None, doc or 0, key, text)
        groups[group] = min(groups.get(group, best), best)
    left = [(None if absent else doc, text) for absent, doc, _, text in groups.values()]
    dirty = {number for number, *_ in test_decontaminate.brute(items, [t for _, t in left])}
    return [(doc, redacted(text)) for k, (doc, text) in enumerate(left) if k not in dirty]


def test_all_stages_against_plain_python(spark, tmp_path):
    items = items_of(4)
    trusted = [(k, prose(k, 60 + k % 50)) for k in range(80)]
    noise = [(1000 + k, " ".join(w + "%&$#" for w in prose(k, 50).upper().split())) for k in range(4)]
    copies = [(2000 + k, f"{prose(k, 60 + k % 50)} end") for k in range(0, 20, 2)] + [(2100, trusted[30][1]), (None, trusted[31][1]), (None, trusted[31][1])]
    dirty = [(3000 + k, f"{prose(100 + k, 40)} {t} {prose(200 + k, 30)}") for k, (_, t) in enumerate(items[:3])] + [(None, f"{prose(7, 9)} {items[3][1]}")]
    secret = [(4000 + k, f"{prose(300 + k, 60)} password = abcdefgh{k} {prose(400 + k, 60)}") for k in range(3)]
    same_id = [(5000, prose(500, 70)), (5000, prose(501, 70)), (None, prose(502, 70)), (5001, None), (5002, " \n")]
    rows = trusted + noise + copies + dirty + secret + same_id
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(80)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = survivors(spark, rows, set(range(80)), items)
    kept = {doc for doc, _ in want}
    assert not kept & {1000, 2000, 2100, 3000, 5001, 5002} and len(kept & set(range(80))) > 70 and 5000 in kept
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = [(doc, np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4")) for doc, t in want]
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(((r["doc_id"], r["doc_tokens"]) for r in pieces if r["start"] == 0), key=repr) == sorted(((doc, len(x)) for doc, x in ids), key=repr)
    assert sum(r["length"] for r in pieces) == sum(len(x) for _, x in ids)
    for r in pieces:
        cut = slice(r["start"], r["start"] + r["length"])
        assert any(doc == r["doc_id"] and zlib.crc32(x[cut].tobytes()) == r["ids_crc32"] for doc, x in ids)
