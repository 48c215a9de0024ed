"""Token files: exact round trips, random access, order, and the library's ids."""

from __future__ import annotations

import io
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from relievo.llm import token_files
from relievo.llm.tokens import tokenizer
from relievo.plans.storage import new_folder
from tests.llm.fixtures import cases, documents, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=60))
def test_packing_of_any_width(width, values):
    ids = np.array([v & ((1 << width) - 1) for v in values], np.uint32)
    data = token_files.pack_ids(ids, width)
    assert len(data) == -(-len(ids) // 8) * width
    assert token_files.unpack_ids(data, width, len(ids)).tolist() == ids.tolist()
    bits = sum(int(v) << (k * width) for k, v in enumerate(ids))
    assert int.from_bytes(data, "little") == bits


def file_of(docs, width, block):
    out = io.BytesIO()
    out.close = lambda: None
    f = token_files.TokenFile(out, width, block)
    for d, ids in docs:
        f.add(d, np.array(ids, np.uint32))
    f.close()
    return out.getvalue()


@pytest.mark.parametrize("width", [16, 17])
def test_random_access(width):
    rng = np.random.default_rng(3)
    docs = [(None if k == 4 else k, rng.integers(0, 1 << width, n).tolist()) for k, n in enumerate([5, 0, 64, 200, 1, 63, 700])]
    data = file_of(docs, width, 64)
    reader = token_files.TokenReader(pa.BufferReader(data))
    reader.verify()
    every = [i for _, ids in docs for i in ids]
    for a in (0, 1, 63, 64, 65, 300, len(every)):
        for b in (a, a + 1, a + 64, len(every)):
            b = max(a, min(b, len(every)))
            assert [int(i) for part in reader.ids(a, b) for i in part] == every[a:b]
    names, places = reader.documents(2, 7)
    assert names == [d for d, _ in docs[2:]] and places == [5, 69, 269, 270, 333, 1033]
    assert token_files._checksums(reader, places) == [zlib.crc32(np.array(ids, "<u4").tobytes()) for _, ids in docs[2:]]
    with pytest.raises(ValueError):
        token_files.TokenReader(pa.BufferReader(data[:-3]))
    broken = bytearray(data)
    broken[-60] ^= 1
    with pytest.raises(ValueError):
        token_files.TokenReader(pa.BufferReader(bytes(broken))).verify()


def expected(rows):
    encoded = []
    for d, t in rows:
        ids = np.array([*tokenizer(PATH).encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        encoded.append((d is not None, d or 0, zlib.crc32(ids.astype("<u2").tobytes()), ids.tobytes()))
    out, at = [], 0
    for known, d, _, ids in sorted(encoded, key=lambda x: x[:3]):
        out.append((d if known else None, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    return sorted(out, key=lambda x: x[1])


def test_documents(spark):
    got = sorted((tuple(r) for r in token_files.roundtrip(documents(spark), PATH).collect()), key=lambda x: x[1])
    assert got == expected([(r[0], r[1]) for r in cases()])
    assert token_files.roundtrip(documents(spark).limit(0), PATH).count() == 0


def test_a_hot_id_spreads_over_ranges(spark):
    rows = [(7 if k % 2 else k, prose(k, 5 + k % 40)) for k in range(200)] + [(None, prose(k, 9)) for k in range(60)]
    docs = documents(spark, [(d, t, "en", "s", 1, 1, "k", "s", "l") for d, t in rows])
    uri = new_folder(spark, "test-tokens")
    manifest = token_files.write_tokens(docs, uri, PATH, block=64)
    assert manifest.select("part").distinct().count() == 4
    got = sorted((tuple(r) for r in token_files.read_tokens(manifest, uri).collect()), key=lambda x: x[1])
    assert got == expected(rows)


def test_ranges_are_in_order():
    bounds = np.array([3, 7, 7, 7, 9])
    key, spread = np.array([1, 3, 3, 5, 7, 7, 7, 8, 9, 10]), np.array([0.9, 0.2, 0.8, 0.5, 0.0, 0.6, 0.99, 0.1, 0.7, 0.0])
    got = token_files.range_of(bounds, key, spread)
    assert got.tolist() == sorted(got.tolist()) and got[4] == 1 and got[6] == 4 and got[-1] == 5


def test_small_files_and_ranges(spark, monkeypatch):
    out, made = [], {}

    class Store:
        def open_output_stream(self, name, compression=None):
            made[name] = buffer = io.BytesIO()
            buffer.close = lambda: None
            return buffer

    monkeypatch.setattr(token_files, "FILE_IDS", 50)
    monkeypatch.setattr(token_files, "RANGE_IDS", 20)
    part = token_files._Part(Store(), "x", 3, 16, 8)
    docs = [(k, list(range(k % 9))) for k in range(60)]
    for d, ids in docs:
        part.add(d, np.array(ids, "<u2"))
    part.close()
    assert len(made) > 3
    for _, name, first, stop, first_id, n in part.rows:
        reader = token_files.TokenReader(pa.BufferReader(made[f"x/{name}"].getvalue()))
        names, places = reader.documents(first, stop)
        assert places[-1] - places[0] == n
        for d, a, b in zip(names, places, places[1:]):
            out.append((d, first_id + a - places[0], [int(i) for p in reader.ids(a, b) for i in p]))
    at = 0
    for (d, ids), got in zip(docs, out, strict=True):
        assert got == (d, at, ids)
        at += len(ids)
