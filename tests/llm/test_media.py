from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import pytest

from relievo.llm import media
from tests.llm.fixtures import documents


def test_png_round_trip_and_damage():
    for data in (b"", b"a", b"x" * 64, bytes(range(256)) * 300):
        payload = media.pad(data)
        assert len(payload) % 64 == 0 and payload and media.decode_png(media.encode_png(payload)) == payload
    broken = bytearray(media.encode_png(media.pad(b"hello")))
    broken[45] ^= 1
    with pytest.raises((ValueError, zlib.error)):
        media.decode_png(bytes(broken))


def test_every_case_against_plain_python(spark):
    docs = documents(spark)
    want = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    rows = sorted(media.media_features(docs).collect(), key=lambda r: (repr(r["doc_id"]), r["n_bytes"]))
    plain = sorted(((i, (t or "").encode()) for i, t in want), key=lambda p: (repr(p[0]), len(p[1])))
    assert len(rows) == len(plain)
    for r, (i, data) in zip(rows, plain, strict=True):
        payload = media.pad(data)
        stored = media.encode_png(payload)
        assert (r["doc_id"], r["n_bytes"], r["payload_bytes"]) == (i, len(data), len(payload))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-64:])
        assert (r["media_bytes"], r["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest())
        assert r["feature"] == media.payload_feature(payload)
    assert media.media_features(docs.limit(0)).count() == 0


def plain_png(payload):
    """A grey PNG of one row, put together by hand."""
    chunk = lambda kind, body: len(body).to_bytes(4, "big") + kind + body + zlib.crc32(body, zlib.crc32(kind)).to_bytes(4, "big")
    head = len(payload).to_bytes(4, "big") + (1).to_bytes(4, "big") + bytes([8, 0, 0, 0, 0])
    return bytes([137, 80, 78, 71, 13, 10, 26, 10]) + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(bytes(1) + payload, 4)) + chunk(b"IEND", b"")


def plain_feature(payload):
    n, counts = len(payload), Counter(payload)
    mean = sum(payload) / n
    spread = math.sqrt(sum(c * v * v for v, c in counts.items()) / n - mean * mean)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    quarters = [sum(c for v, c in counts.items() if v // 64 == q) / n for q in range(4)]
    return [mean, spread, entropy, *quarters]


def test_stored_form_and_feature_by_hand(spark):
    texts = ["", "a", "x" * 64, "ä漢" * 50, "The quick brown fox " * 300]
    docs = documents(spark, [(k, t, "en", "s", 0, 0, "", "", "") for k, t in enumerate(texts)])
    for r in media.media_features(docs).collect():
        data = texts[r["doc_id"]].encode()
        payload = data + bytes((64 - len(data) % 64) % 64 if data else 64)
        stored = plain_png(payload)
        assert (r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest())
        assert [float(x) for x in r["feature"].split("|")] == pytest.approx(plain_feature(payload), abs=6e-5)


def test_small_ranges_and_archives_lose_nothing(spark, tmp_path):
    docs = documents(spark)
    docs.sparkSession.dataSource.register(media.MediaArchive)
    uri = tmp_path.as_uri()
    media.write_media(docs.repartition(3), uri)
    whole = media.read_media(spark, uri)
    cut = media.read_media(spark, uri, split_bytes=300, batch_bytes=100)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, cut.collect())) and cut.count() == docs.count()


def test_a_damaged_member_is_not_read(spark, tmp_path):
    media.write_media(documents(spark).where("doc_id = 1"), tmp_path.as_uri())
    (archive,) = tmp_path.glob("*.zip")
    data = bytearray(archive.read_bytes())
    data[200] ^= 255
    archive.write_bytes(data)
    with pytest.raises(Exception, match="damaged"):
        media.read_media(spark, tmp_path.as_uri(), retries=1).collect()
