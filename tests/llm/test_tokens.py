from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from relievo.llm import packing, tokens
from tests.llm.fixtures import documents

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x2FF, exclude_categories=["Cs"]), st.sampled_from(" \n\t'’“—€<|endoftext|>sStT漢İß½²"))), max_size=5))
def test_counts_and_ids_equal_the_library(texts):
    library = Tokenizer.from_file(BYTE)
    assert tokens._counter(BYTE)(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    library, encode = Tokenizer.from_file(WORD), packing.encoder(WORD)
    for t in texts:
        assert [int.from_bytes(encode(t)[i : i + 4], "little") for i in range(0, len(encode(t)), 4)] == library.encode(t, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(
    st.characters(exclude_categories=["Cs"]), st.characters(min_codepoint=0x370, max_codepoint=0x52F), st.characters(min_codepoint=0x4E00, max_codepoint=0x4EFF),
    st.sampled_from(" \n'st12٣五Ⅷ½\u3000\u2028\u1680\x1c\x1f\u200b\u0301😀"),
)), max_size=6))
def test_counts_equal_the_library_in_any_script(texts):
    library = Tokenizer.from_file(BYTE)
    assert tokens._counter(BYTE)(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    for t in texts:
        if not tokens.specials(BYTE).search(t):
            assert "".join(tokens.pre_tokens(BYTE, t)) == t


def test_other_scripts_take_the_shortcut():
    for text in ("Привет мир, как дела", "καλημέρα κόσμε", "日本語 の文章"):
        assert len(tokens.pre_tokens(BYTE, text)) > 1
    assert any("\u0400" <= c for s in tokens.whole_tokens(BYTE) for c in s)


def test_whole_tokens_are_proven():
    library = Tokenizer.from_file(BYTE)
    whole = sorted(tokens.whole_tokens(BYTE))
    assert len(whole) > 40000
    for s in whole[::500]:
        assert len(library.encode(s, add_special_tokens=False).ids) == 1


def test_every_case(spark):
    library = Tokenizer.from_file(BYTE)
    docs = documents(spark)
    want = sorted(((r["doc_id"], len((r["text"] or "").encode()), n := len(library.encode(r["text"] or "", add_special_tokens=False).ids), n > 512) for r in docs.collect()), key=repr)
    assert sorted((tuple(r) for r in tokens.count_tokens(docs, BYTE).collect()), key=repr) == want
    assert tokens.count_tokens(docs.limit(0), BYTE).count() == 0


def test_packing_every_case(spark):
    library = Tokenizer.from_file(WORD)
    docs = documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    ids = {r["doc_id"]: np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4") for r in docs.collect()}
    rows = packing.pack(docs, WORD).collect()
    sequences: dict[int, list] = {}
    seen = {d: [] for d in ids}
    for r in rows:
        seen[r["doc_id"]].append((r["start"], r["length"]))
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts, total in ((seen[d], len(ids[d])) for d in ids):
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == total
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096
    repeated = packing.pack(documents(spark), WORD)
    assert repeated.agg({"length": "sum"}).first()[0] == sum(len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in documents(spark).collect())
    assert packing.pack(docs.limit(0), WORD).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(1, 70), st.integers(1, 5000), st.sampled_from([4096, 2048, 1365, 1366, 12000])), max_size=120))
def test_bins_hold_their_class_s_number_of_documents(sizes):
    packer = packing.Packer(3)
    for doc, n in enumerate(sizes):
        packer.add(doc, np.arange(n, dtype="<u4").tobytes())
    packer.finish()
    ends, bins, placed = {}, {}, {}
    for doc, start, length, crc, total, sequence, offset, kind in packer.rows:
        assert length > 0 and ends.get(sequence, 0) == offset and total == sizes[doc]
        assert crc == zlib.crc32(np.arange(start, start + length, dtype="<u4").tobytes())
        ends[sequence] = offset + length
        placed.setdefault(doc, []).append((start, length))
        bins.setdefault(sequence, []).append((kind, doc, start, length))
    for doc, n in enumerate(sizes):
        at = 0
        for start, length in sorted(placed[doc]):
            assert start == at
            at += length
        assert at == n
    assert all(n <= 4096 and n & (n - 1) == 0 for n in ends.values())  # no padding
    assert sum(n < 4096 for n in ends.values()) <= 12 and min(ends, default=3 << 40) >= 3 << 40
    for pieces in bins.values():
        kinds = [k for k, *_ in pieces if k]
        assert not kinds or set(kinds) == {len(kinds)}
        assert all(start == 0 and length == sizes[doc] and 4096 // length == k for k, doc, start, length in pieces if k)


def test_documents_with_bins_stay_whole():
    r = np.random.default_rng(1)
    sizes = r.integers(100, 4096, 3000).tolist()
    packer = packing.Packer(0)
    for doc, n in enumerate(sizes):
        packer.add(doc, bytes(4 * n))
    packer.finish()
    assert sum(kind > 0 for *_, kind in packer.rows) > 0.6 * len(sizes)
