"""Dictionary-compressed WARC archives, written and read back by byte range.

Each task trains a Zstandard dictionary on a bounded sample of the records that
it archives, puts it in a leading skippable frame of each of its files, and
compresses every record as a frame of its own. The manifest lists byte ranges of
the files of successful attempts only; readers load a file's dictionary and the
frames of their range.

Defined cases: null html is an empty payload; a null url is written as an empty
target; equal payloads of at least 1000 bytes have one response, the largest
non-null page_id, which the others revisit (all are responses if every id is
null); repeated rows are written once each, and of the rows of the largest page_id with
one payload all are responses; payloads are taken whole, of any length; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relievo.plans.storage import materialize, new_folder
from relievo.plans.text import text_or_empty

#: Payloads below this size are never revisited.
LEAST_REVISIT = 1000
_DICTIONARY_FRAME = 0x184D2A5D
_DICTIONARY_BYTES, _SAMPLE_BYTES = 64 << 10, 3 << 20
_FILE_BYTES, _RANGE_BYTES = 128 << 20, 4 << 20
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit record without the payload."""
    name = "" if page_id is None else page_id
    sha = base64.b32encode(bytes.fromhex(digest)).decode()
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>",
        "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Target-URI: {' '.join((url or '').split())}", f"WARC-Payload-Digest: sha1:{sha}",
        f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response",
    ]
    block = _HTTP % len(payload) + payload
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        block = _HTTP % len(payload)
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[int | None, int, str, str, int | None]:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)``; damage raises."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind, size = fields["WARC-Type"], int(fields["X-Payload-Length"])
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError("the payload does not match its digest")
        digest = hashlib.sha1(payload).hexdigest()
    number = lambda field: int(fields[field][10:-1]) if field in fields and fields[field] != "<urn:page:>" else None
    return number("WARC-Record-ID"), size, digest, kind, number("WARC-Refers-To")


def train(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary of the samples; few or small ones serve as they are."""
    try:
        return zstandard.train_dictionary(_DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:_DICTIONARY_BYTES] or b"WARC/1.1 ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)


_RANGES = "file string, start bigint, stop bigint, n bigint"
_RANGES_ARROW = pa.schema([("file", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("n", pa.int64())])


class _File:
    """One archive: dictionary frame first, then a frame for each record."""

    def __init__(self, store, base: str, press: zstandard.ZstdCompressor, dictionary: bytes):
        self.name, self.press = f"{uuid.uuid4().hex}.warc.zst", press
        self.out = store.open_output_stream(f"{base}/{self.name}", compression=None)
        self.out.write(struct.pack("<II", _DICTIONARY_FRAME, len(dictionary)) + dictionary)
        self.at = self.start = 8 + len(dictionary)
        self.n, self.ranges = 0, []

    def add(self, data: bytes) -> None:
        frame = self.press.compress(data)
        self.out.write(frame)
        self.at, self.n = self.at + len(frame), self.n + 1
        if self.at - self.start >= _RANGE_BYTES:
            self._cut()

    def _cut(self) -> None:
        if self.n:
            self.ranges.append((self.name, self.start, self.at, self.n))
        self.start, self.n = self.at, 0

    def close(self) -> list[tuple]:
        self._cut()
        self.out.close()
        return self.ranges


def _write(uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(uri)
        store.create_dir(base, recursive=True)
        held, size, file, press, dictionary, ranges = [], 0, None, None, b"", []

        def put(data: bytes) -> None:
            nonlocal file
            if file is None:
                file = _File(store, base, press, dictionary)
            file.add(data)
            if file.at >= _FILE_BYTES:
                ranges.extend(file.close())
                file = None

        def begin() -> None:
            nonlocal press, dictionary
            trained = train(held)
            dictionary = trained.as_bytes()
            press = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True)
            for data in held:
                put(data)
            held.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = record(row[0], row[1], row[2].encode(), row[3], row[4])
                if press:
                    put(data)
                    continue
                held.append(data)
                size += len(data)
                if size >= _SAMPLE_BYTES:
                    begin()
        if held:
            begin()
        if file is not None:
            ranges.extend(file.close())
        if ranges:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*ranges), _RANGES_ARROW, strict=True)], schema=_RANGES_ARROW)

    return run


_RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
_RECORDS_ARROW = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
)


def _read(uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for name, start, stop, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with store.open_input_file(f"{base}/{name}") as f:
                    magic, size = struct.unpack("<II", f.read(8))
                    if magic != _DICTIONARY_FRAME:
                        raise ValueError(f"{name} has no dictionary frame")
                    raw = f.read(size)
                    f.seek(start)
                    data = f.read(stop - start)
                kind = zstandard.DICT_TYPE_AUTO
                unpress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=kind))
                rows, at = [], 0
                while at < len(data):
                    one = unpress.decompressobj()
                    rows.append(parse_record(one.decompress(memoryview(data)[at:])))
                    at = len(data) - len(one.unused_data)
                if len(rows) != n:
                    raise ValueError(f"{name} holds {len(rows)} records in a range of {n}")
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORDS_ARROW, strict=True)], schema=_RECORDS_ARROW)

    return run


def write_warc(pages: DataFrame, uri: str) -> DataFrame:
    """Write a record for every page below ``uri``; the manifest of byte ranges.

    Which page an equal payload revisits is settled on ids, sizes and digests
    alone; page texts move once, by page_id, so copies do not meet in a task.
    """
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text_or_empty("html").alias("html"))
    page = page.withColumn("digest", F.sha1(F.encode("html", "utf-8")))
    keys = page.where(F.octet_length("html") >= LEAST_REVISIT).select("page_id", "digest")
    first = keys.groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1 and response is not null")
    revisits = keys.join(first, "digest").where("page_id is null or page_id <> response").select("page_id", "digest", "response").distinct()
    revisits = revisits.select(F.col("page_id").alias("known_id"), F.col("digest").alias("known_digest"), F.col("response").alias("refers_to"))
    on = F.col("page_id").eqNullSafe(F.col("known_id")) & (F.col("digest") == F.col("known_digest"))
    rows = page.join(revisits, on, "left").select("page_id", "url", "html", "digest", "refers_to")
    return materialize(rows.mapInArrow(_write(uri), _RANGES), "warc")


def read_warc(manifest: DataFrame, uri: str) -> DataFrame:
    """What the records of the manifest's ranges say."""
    ranges = manifest.count()
    return manifest.repartition(max(1, ranges), "file", "start").mapInArrow(_read(uri), _RECORDS)


def roundtrip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives and read the archives back."""
    uri = new_folder(pages.sparkSession, "warc-files")
    return read_warc(write_warc(pages, uri), uri)
