from __future__ import annotations

import hashlib

import pytest

from relievo.llm import warc


def brute(rows):
    payload = lambda h: (h or "").encode()
    best = {}
    for p, _, h in rows:
        if p is not None and len(payload(h)) >= 1000:
            best[payload(h)] = max(best.get(payload(h), p), p)
    out = []
    for p, _, h in rows:
        to = best.get(payload(h))
        to = None if to == p else to
        out.append((p, len(payload(h)), hashlib.sha1(payload(h)).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


def test_round_trip_of_every_case(spark):
    big, other = "<p>é</p>" * 200, "<p>x</p>" * 200
    rows = [(1, "http://a", big), (2, "http://b\r\nX: y", big), (3, None, other), (None, "u", big), (None, "u", None), (4, "u", "small"), (5, "u", "small"), (6, "u", ""), (7, "u", "z" * 300000), (3, None, other)]
    pages = spark.createDataFrame([(*r, 1, "d") for r in rows], "page_id long, url string, html string, refers_to int, digest string")
    assert sorted((tuple(r) for r in warc.roundtrip(pages).collect()), key=repr) == brute(rows)
    assert warc.roundtrip(pages.limit(0)).count() == 0


def test_many_records_in_ranges(spark, tmp_path, monkeypatch):
    rows = [(k, f"http://h/{k}", f"<p>{k}</p>" * (k % 50)) for k in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    manifest = warc.write_warc(pages, tmp_path.as_uri())
    assert sorted((tuple(r) for r in warc.read_warc(manifest, tmp_path.as_uri()).collect()), key=repr) == brute(rows)
    import struct

    for f in tmp_path.glob("*.warc.zst"):
        magic, size = struct.unpack("<II", f.read_bytes()[:8])
        assert magic == 0x184D2A5D and size > 0


def test_a_wrong_payload_is_not_read():
    good = warc.record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None)
    assert warc.parse_record(good)[0] == 1
    with pytest.raises(ValueError):
        warc.parse_record(good.replace(b"\r\npayload", b"\r\npaYload"))


def test_a_payload_that_a_third_of_all_pages_share(spark):
    rows = [(k, f"http://h/{k}", "<p>same</p>" * 200 if k % 3 == 0 else f"<p>{k}</p>" * 150) for k in range(900)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    got = sorted((tuple(r) for r in warc.roundtrip(pages).collect()), key=repr)
    assert got == brute(rows) and sum(r[3] == "revisit" for r in got) == 299
