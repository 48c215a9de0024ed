"""Media columns: payloads as PNG samples in ZIP archives, read by byte range.

``media_archive`` is a Python data source. Its writer stores one PNG per row in
ZIP archives of bounded size; its reader cuts the archives into byte ranges,
finds the members that start in a range from the archive's central directory,
and reads each member on its own by its offset.

Defined cases: null texts count as empty; a null id stays null; equal texts give
equal results, so there are no ties; repeated rows are stored and returned once
each; an empty table gives an empty result; texts are taken whole, and one longer
than an archive's or a batch's size is alone in it; other columns of the input are
ignored.
"""

from __future__ import annotations

import hashlib
import json
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from relievo.plans.storage import new_folder
from relievo.plans.text import text_or_empty

UNIT = 64
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
MEMBER_SCHEMA = "key bigint, n_bytes bigint, media binary"
_MEMBER_ARROW = pa.schema([("key", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])


def pad(data: bytes) -> bytes:
    """Append zero bytes up to a positive multiple of 64."""
    return data + bytes(-len(data) % UNIT if data else UNIT)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_png(payload: bytes, level: int = 4) -> bytes:
    """One row of 8-bit grey samples, a sample for each byte."""
    head = struct.pack(">IIBBBBB", len(payload), 1, 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(b"\0" + payload, level)) + _chunk(b"IEND", b"")


def decode_png(media: bytes) -> bytes:
    """The samples of :func:`encode_png`; damaged chunks raise ``ValueError``."""
    if media[:8] != _SIGNATURE:
        raise ValueError("not a PNG")
    at, data, size = 8, [], None
    while at < len(media):
        (n,) = struct.unpack_from(">I", media, at)
        kind, body = media[at + 4 : at + 8], media[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack_from(">I", media, at + 8 + n)[0]:
            raise ValueError("damaged chunk")
        if kind == b"IHDR":
            size = struct.unpack_from(">I", body)[0]
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + n
    samples = zlib.decompress(b"".join(data))
    if size is None or len(samples) != size + 1 or samples[0]:
        raise ValueError("unexpected sample layout")
    return samples[1:]


@dataclass
class _Written(WriterCommitMessage):
    files: list


class _ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, path: str, archive_bytes: int):
        self.path, self.archive_bytes = path, archive_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        store, base = fs.FileSystem.from_uri(self.path)
        store.create_dir(base, recursive=True)
        files, archive, stream, filled, serial = [], None, None, 0, 0
        for batch in iterator:
            for key, size, media in zip(*(batch.column(n).to_pylist() for n in ("key", "n_bytes", "media")), strict=True):
                if archive is None:
                    name = f"{uuid.uuid4().hex}.zip"  # a retried task writes other files
                    stream = store.open_output_stream(f"{base}/{name}")
                    archive, filled, serial = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED), 0, 0
                    files.append(name)
                info = zipfile.ZipInfo(f"{serial:08d}.png")
                info.comment = json.dumps([key, size]).encode()
                archive.writestr(info, media)
                filled, serial = filled + len(media), serial + 1
                if filled >= self.archive_bytes:
                    archive.close()
                    stream.close()
                    archive = None
        if archive is not None:
            archive.close()
            stream.close()
        return _Written(files)

    def commit(self, messages: list) -> None:
        store, base = fs.FileSystem.from_uri(self.path)
        store.create_dir(base, recursive=True)
        names = sorted(n for m in messages if m is not None for n in m.files)
        with store.open_output_stream(f"{base}/{uuid.uuid4().hex}.manifest") as out:
            out.write("\n".join(names).encode())

    def abort(self, messages: list) -> None:
        store, base = fs.FileSystem.from_uri(self.path)
        for name in (n for m in messages if m is not None for n in m.files):
            store.delete_file(f"{base}/{name}")


@dataclass
class _ByteRange(InputPartition):
    file: str
    start: int
    end: int


class _ArchiveReader(DataSourceReader):
    def __init__(self, path: str, split_bytes: int, batch_bytes: int, retries: int):
        self.path, self.split_bytes, self.batch_bytes, self.retries = path, split_bytes, batch_bytes, retries

    def partitions(self) -> list:
        store, base = fs.FileSystem.from_uri(self.path)
        there = {i.base_name: i.size for i in store.get_file_info(fs.FileSelector(base, allow_not_found=True)) if i.is_file}
        ranges = []
        for manifest in sorted(n for n in there if n.endswith(".manifest")):
            with store.open_input_stream(f"{base}/{manifest}") as f:
                names = f.read().decode().split()
            for name in names:
                ranges += [_ByteRange(name, at, at + self.split_bytes) for at in range(0, there[name], self.split_bytes)]
        return ranges or [_ByteRange("", 0, 0)]

    def read(self, partition: _ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        store, base = fs.FileSystem.from_uri(self.path)
        path = f"{base}/{partition.file}"
        members = self._patiently(lambda: self._directory(store, path))
        rows, held = [], 0
        for info in members:
            if not partition.start <= info.header_offset < partition.end:
                continue
            media = self._patiently(lambda info=info: self._member(store, path, info))
            rows.append((*json.loads(info.comment), media))
            held += len(media)
            if held >= self.batch_bytes:
                yield self._batch(rows)
                rows, held = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _MEMBER_ARROW, strict=True)], schema=_MEMBER_ARROW)

    @staticmethod
    def _directory(store, path: str) -> list:
        with store.open_input_file(path) as f, zipfile.ZipFile(f) as archive:
            return sorted(archive.infolist(), key=lambda i: i.header_offset)

    @staticmethod
    def _member(store, path: str, info: zipfile.ZipInfo) -> bytes:
        """A stored member's bytes, found by its offset; a wrong checksum raises."""
        with store.open_input_file(path) as f:
            f.seek(info.header_offset)
            head = f.read(30)
            names = int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little")
            f.seek(info.header_offset + 30 + names)
            data = f.read(info.file_size)
        if head[:4] != b"PK\x03\x04" or zlib.crc32(data) != info.CRC:
            raise OSError(f"member {info.filename} of {path} is damaged")
        return data

    def _patiently(self, read):
        for attempt in range(self.retries + 1):
            try:
                return read()
            except (OSError, zipfile.BadZipFile):
                if attempt == self.retries:
                    raise
                time.sleep(min(0.1 * 2**attempt, 5))


class MediaArchive(DataSource):
    """Options: path, archive_bytes (write), split_bytes, batch_bytes, retries (read)."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return MEMBER_SCHEMA

    def writer(self, schema, overwrite: bool) -> _ArchiveWriter:
        return _ArchiveWriter(self.options["path"], int(self.options.get("archive_bytes", 128 << 20)))

    def reader(self, schema) -> _ArchiveReader:
        o = self.options
        return _ArchiveReader(o["path"], int(o.get("split_bytes", 32 << 20)), int(o.get("batch_bytes", 8 << 20)), int(o.get("retries", 4)))


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            data = [t.encode() for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(d) for d in data], pa.int64()), pa.array([encode_png(pad(d)) for d in data], pa.binary())],
                schema=_MEMBER_ARROW,
            )


def payload_feature(payload: bytes) -> str:
    """Mean, deviation and entropy of the samples, and the share of each quarter of their range."""
    n = len(payload)
    counts = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    values = np.arange(256)
    mean = int((counts * values).sum()) / n
    spread = (int((counts * values * values).sum()) / n - mean * mean) ** 0.5
    share = counts[counts > 0] / n
    entropy = float(-(share * np.log2(share)).sum())
    quarters = counts.reshape(4, 64).sum(axis=1) / n
    return f"{mean:.4f}|{spread:.4f}|{entropy:.4f}|" + "|".join(f"{q:.4f}" for q in quarters)


_FEATURES = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()),
     ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]
)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, size, media in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            payload = decode_png(media)
            rows.append(
                (key, size, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]),
                 len(media), hashlib.sha256(media).hexdigest(), payload_feature(payload))
            )
        columns = zip(*rows) if rows else [[] for _ in _FEATURES]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _FEATURES, strict=True)], schema=_FEATURES)


def write_media(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Store each text's payload as a PNG in archives below ``path``."""
    docs.sparkSession.dataSource.register(MediaArchive)
    pairs = docs.select(F.col(key).cast("long").alias("key"), text_or_empty(text).alias("text"))
    pairs.mapInArrow(_encode, MEMBER_SCHEMA).write.format("media_archive").mode("append").save(path)


def read_media(spark: SparkSession, path: str, **options: int) -> DataFrame:
    """``(key, n_bytes, media)`` of every member of the archives below ``path``."""
    spark.dataSource.register(MediaArchive)
    return spark.read.format("media_archive").options(**{k: str(v) for k, v in options.items()}).load(path)


def media_features(docs: DataFrame) -> DataFrame:
    """Store the payload of every document and compute features of what is read back."""
    path = new_folder(docs.sparkSession, "media")
    write_media(docs, path)
    schema = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
    return read_media(docs.sparkSession, path).mapInArrow(_features, schema)
