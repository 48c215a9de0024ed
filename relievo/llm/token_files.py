"""Token ids in files of fixed-width bit-packed numbers.

A file holds the ids of its documents one after another, each in the least number of
bits that holds every id of the vocabulary (16 for 50,257). Ids are packed in blocks of
BLOCK, which start at whole bytes; the footer has the offset of each block, and of each
document its id and the place of its first token. So a reader seeks to the blocks that
it needs and unpacks them eight numbers at a time for all groups at once.

::

    "RTK1" width block_ids  | blocks | block offsets, document ids, null flags, first tokens | counts, footer's place and crc32, "RTK1"

Documents are encoded where they are read; what moves is ids as 2- or 4-byte
numbers. They go to as many ranges of doc_id as there are shuffle partitions, whose
bounds are approximate quantiles, and within a range they are sorted. A doc_id that
stands for several bounds, as a third of all rows may have it, spreads over their
ranges by a checksum, which also orders rows of one id. A range is written by one task
to files of bounded size, whose names no other attempt uses; the manifest names
those of successful attempts only.

Defined cases: a null text is empty and has its end token only; rows without an id
come first; repeated rows are written once each, rows of one id ordered by checksum
and ids; an empty table gives no file and an empty result; texts are taken whole, very
long ones alone; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relievo.llm.tokens import _BYTE_CHARS, pre_tokens, slices, specials, tokenizer
from relievo.plans.storage import delete, materialize, new_folder
from relievo.plans.text import text_or_empty

END_ID = 2
#: Ids of a block, a multiple of 8 so that blocks end at whole bytes.
BLOCK = 1 << 16
#: A file is closed after so many ids or documents, and is read in ranges of so many ids.
FILE_IDS, FILE_DOCS, RANGE_IDS = 1 << 26, 1 << 20, 1 << 22
#: Distinct pre-tokens that a worker remembers before it forgets them all.
MEMORY = 1 << 20
_MAGIC = b"RTK1"
_HEAD, _TAIL = struct.Struct("<4sII"), struct.Struct("<QQQQI4s")
_LEAST = -(1 << 63)


def id_width(path: str, end_id: int = END_ID) -> int:
    """Bits that hold every id of the tokenizer and the end id."""
    return max(tokenizer(path).get_vocab_size(with_added_tokens=True) - 1, end_id, 1).bit_length()


def pack_ids(ids: np.ndarray, width: int) -> bytes:
    """Ids in ``width`` bits each, lowest bits first, filled up with zeros to whole groups of eight."""
    groups = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    groups.reshape(-1)[: len(ids)] = ids
    out = np.zeros((len(groups), width + 8), np.uint8)
    for j in range(8):
        byte, shift = divmod(j * width, 8)
        moved = (groups[:, j] << np.uint64(shift)).astype("<u8").view(np.uint8).reshape(-1, 8)
        out[:, byte : byte + 5] |= moved[:, :5]
    return out[:, :width].tobytes()


def unpack_ids(data: bytes, width: int, n: int) -> np.ndarray:
    """The first ``n`` ids of what :func:`pack_ids` has made."""
    rows = np.frombuffer(data, np.uint8).reshape(-1, width)
    wide = np.zeros((len(rows), width + 8), np.uint8)
    wide[:, :width] = rows
    out = np.empty((len(rows), 8), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for j in range(8):
        byte, shift = divmod(j * width, 8)
        window = np.ascontiguousarray(wide[:, byte : byte + 8]).view("<u8")[:, 0]
        out[:, j] = (window >> np.uint64(shift)) & mask
    return out.reshape(-1)[:n]


class TokenFile:
    """Writes documents to one file; memory holds a block and the footer."""

    def __init__(self, out, width: int, block: int = BLOCK):
        self.out, self.width, self.block = out, width, block
        self.out.write(_HEAD.pack(_MAGIC, width, block))
        self.held, self.n_held, self.n_ids, self.at = [], 0, 0, _HEAD.size
        self.blocks, self.docs, self.firsts = [], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.firsts.append(self.n_ids)
        self.n_ids += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block:
            rest = np.concatenate(self.held)
            whole = len(rest) // self.block * self.block
            for k in range(0, whole, self.block):
                self._write(rest[k : k + self.block])
            self.held, self.n_held = [rest[whole:]], len(rest) - whole

    def _write(self, ids: np.ndarray) -> None:
        data = pack_ids(ids, self.width)
        self.out.write(data)
        self.blocks.append(self.at)
        self.at += len(data)

    def close(self) -> None:
        if self.n_held:
            self._write(np.concatenate(self.held))
        footer = b"".join((
            np.array([*self.blocks, self.at], "<u8").tobytes(), np.array([d or 0 for d in self.docs], "<i8").tobytes(),
            np.array([d is None for d in self.docs], np.uint8).tobytes(), np.array([*self.firsts, self.n_ids], "<u8").tobytes(),
        ))
        self.out.write(footer + _TAIL.pack(len(self.blocks), len(self.docs), self.n_ids, self.at, zlib.crc32(footer), _MAGIC))
        self.out.close()


class TokenReader:
    """Random access to a file: any stretch of ids, any stretch of documents."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        self.n_blocks, self.n_docs, self.n_ids, self.footer, self.crc, magic = _TAIL.unpack(self._at(size - _TAIL.size, _TAIL.size))
        start, self.width, self.block = _HEAD.unpack(self._at(0, _HEAD.size))
        if magic != _MAGIC or start != _MAGIC:
            raise ValueError("not a file of token ids")

    def _at(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        data = self.file.read(size)
        if len(data) != size:
            raise ValueError("the file ends too early")
        return data

    def _column(self, before: int, dtype: str, first: int, stop: int) -> np.ndarray:
        size = np.dtype(dtype).itemsize
        return np.frombuffer(self._at(self.footer + before + first * size, (stop - first) * size), dtype)

    def verify(self) -> None:
        """Check the footer's checksum."""
        if zlib.crc32(self._at(self.footer, 8 * (self.n_blocks + 1) + 17 * self.n_docs + 8)) != self.crc:
            raise ValueError("the footer does not match its checksum")

    def documents(self, first: int, stop: int) -> tuple[list[int | None], list[int]]:
        """Ids of these documents, and the places of their first tokens with the place after the last."""
        base = 8 * (self.n_blocks + 1)
        ids = self._column(base, "<i8", first, stop).tolist()
        null = self._column(base + 8 * self.n_docs, "u1", first, stop).tolist()
        places = self._column(base + 9 * self.n_docs, "<u8", first, stop + 1).tolist()
        return [None if z else i for i, z in zip(ids, null, strict=True)], places

    def ids(self, start: int, stop: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` up to ``stop``, a block at a time."""
        if start >= stop:
            return
        first, last = start // self.block, (stop - 1) // self.block
        offsets = self._column(0, "<u8", first, last + 2).tolist()
        for b in range(first, last + 1):
            data = self._at(offsets[b - first], offsets[b - first + 1] - offsets[b - first])
            here = unpack_ids(data, self.width, min(self.block, self.n_ids - b * self.block))
            yield here[max(0, start - b * self.block) : stop - b * self.block]


@cache
def encoder(path: str) -> Callable[[str], bytes]:
    """A function from a text to its ids as little-endian 32-bit bytes, as the library gives them.

    A worker keeps it, with the pre-tokens that it has met, from task to task.
    """
    tok, special = tokenizer(path), specials(path)
    merge, known = tok.model.tokenize, {}

    def encode(text: str) -> bytes:
        if special and special.search(text):
            return np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        pieces = pre_tokens(path, text)
        try:
            return b"".join([known[p] for p in pieces])
        except KeyError:
            if len(known) > MEMORY:
                known.clear()
            for p in pieces:
                if p not in known:
                    known[p] = np.array([t.id for t in merge(p.encode().decode("latin-1").translate(_BYTE_CHARS))], "<u4").tobytes()
            return b"".join([known[p] for p in pieces])

    return encode


def _bounds(docs: DataFrame, parts: int) -> list[int]:
    """``parts - 1`` ascending bounds between ranges of doc_id."""
    if parts < 2:
        return []
    at = F.percentile_approx(F.coalesce("doc_id", F.lit(_LEAST)), [k / parts for k in range(1, parts)], 100 * parts)
    return list(docs.agg(at.alias("b")).first()["b"] or [])


def range_of(bounds: np.ndarray, key: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """The range of each key; those that equal bounds spread over the ranges beside them in the order of ``spread``, in [0, 1)."""
    low, high = np.searchsorted(bounds, key, "left"), np.searchsorted(bounds, key, "right")
    return (low + np.floor(spread * (high - low + 1))).astype(np.int64)


_ENCODED = "part int, doc_id bigint, mark bigint, ids binary"
_ENCODED_ARROW = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("mark", pa.int64()), ("ids", pa.binary())])


def _encode(path: str, end_id: int, kind: str, bounds: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, edges = encoder(path), np.array([end_id], "<u4").tobytes(), np.array(bounds, np.int64)
        for batch in batches:
            docs = iter(batch.column("doc_id").to_pylist())
            for texts in slices(batch.column("text").to_pylist()):
                own = [d for _, d in zip(texts, docs)]
                ids = [np.frombuffer(encode(t) + end, "<u4").astype(kind).tobytes() for t in texts]
                mark = np.array([zlib.crc32(x) for x in ids], np.int64)
                part = range_of(edges, np.array([_LEAST if d is None else d for d in own], np.int64), mark / 2.0**32)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((part, own, mark, ids), _ENCODED_ARROW, strict=True)], schema=_ENCODED_ARROW)

    return run


_MANIFEST = "part int, file string, first_doc bigint, stop_doc bigint, first_id bigint, n_ids bigint"
_MANIFEST_ARROW = pa.schema([("part", pa.int32()), ("file", pa.string()), *((c, pa.int64()) for c in ("first_doc", "stop_doc", "first_id", "n_ids"))])


class _Part:
    """The files of one range of doc_id, and the manifest's rows of them."""

    def __init__(self, store, base: str, part: int, width: int, block: int):
        self.store, self.base, self.part, self.width, self.block = store, base, part, width, block
        self.file, self.total, self.rows = None, 0, []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.file is None:
            self.name = f"{self.part:06d}-{uuid.uuid4().hex}.tokens"
            self.file = TokenFile(self.store.open_output_stream(f"{self.base}/{self.name}", compression=None), self.width, self.block)
            self.doc, self.first, self.before = 0, self.total, 0
        self.file.add(doc_id, ids)
        self.total += len(ids)
        if self.total - self.first >= RANGE_IDS:
            self._cut()
        if self.file.n_ids >= FILE_IDS or len(self.file.docs) >= FILE_DOCS:
            self.close()

    def _cut(self) -> None:
        if len(self.file.docs) > self.doc:
            self.rows.append((self.part, self.name, self.doc, len(self.file.docs), self.first, self.total - self.first))
        self.doc, self.first = len(self.file.docs), self.total

    def close(self) -> None:
        if self.file:
            self._cut()
            self.file.close()
            self.file = None


def _write(uri: str, width: int, kind: str, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(uri)
        store.create_dir(base, recursive=True)
        open_, rows = None, []
        for batch in batches:
            for part, doc, ids in zip(batch.column("part").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                if open_ is None or open_.part != part:
                    if open_:
                        open_.close()
                        rows += open_.rows
                    open_ = _Part(store, base, part, width, block)
                open_.add(doc, np.frombuffer(ids.as_buffer(), kind))
        if open_:
            open_.close()
            rows += open_.rows
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _MANIFEST_ARROW, strict=True)], schema=_MANIFEST_ARROW)

    return run


def write_tokens(docs: DataFrame, uri: str, path: str, end_id: int = END_ID, block: int = BLOCK) -> DataFrame:
    """Write every document's ids and the end id below ``uri`` in the order of doc_id; the manifest.

    A row of it is a stretch of documents of a file: ``part`` counts the ranges of
    doc_id, ``first_id`` the ids of its range before the stretch.
    """
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    width = id_width(path, end_id)
    kind = "<u2" if width <= 16 else "<u4"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    encoded = texts.mapInArrow(_encode(path, end_id, kind, _bounds(texts.select("doc_id"), parts)), _ENCODED)
    ordered = encoded.repartitionById(parts, F.col("part")).sortWithinPartitions("part", F.asc_nulls_first("doc_id"), "mark", "ids")
    return materialize(ordered.mapInArrow(_write(uri, width, kind, block), _MANIFEST), "tokens")


_READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
_READ_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in _READ.split(", ")])


def _read(uri: str, before: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for part, name, first, stop, first_id, n_ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with store.open_input_file(f"{base}/{name}") as f:
                    reader = TokenReader(f)
                    if first == 0:
                        reader.verify()
                    docs, places = reader.documents(first, stop)
                    if places[-1] - places[0] != n_ids:
                        raise ValueError(f"{name} holds {places[-1] - places[0]} ids where {n_ids} were written")
                    crcs = _checksums(reader, places)
                    starts = [before[part] + first_id + p - places[0] for p in places[:-1]]
                    sizes = [b - a for a, b in zip(places, places[1:])]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (docs, starts, sizes, crcs)], schema=_READ_ARROW)

    return run


def _checksums(reader: TokenReader, places: list[int]) -> list[int]:
    """The crc32 of the ids between neighbouring places, as 32-bit numbers; every block is unpacked once."""
    crcs, at, k = [0] * (len(places) - 1), places[0], 0
    for ids in reader.ids(places[0], places[-1]):
        data = memoryview(ids.astype("<u4").tobytes())
        end = at + len(ids)
        while k < len(crcs):
            crcs[k] = zlib.crc32(data[4 * (max(places[k], at) - at) : 4 * (min(places[k + 1], end) - at)], crcs[k])
            if places[k + 1] > end:
                break
            k += 1
        at = end
    return crcs


def read_tokens(manifest: DataFrame, uri: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document of the files; a number for each range passes the driver."""
    totals = sorted(tuple(r) for r in manifest.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before = dict(zip([p for p, _ in totals], accumulate([0, *(n for _, n in totals)])))
    return manifest.repartition(max(1, manifest.count()), "file", "first_doc").mapInArrow(_read(uri, before), _READ)


def roundtrip(docs: DataFrame, path: str) -> DataFrame:
    """Write all documents' ids to files, read the files back and delete them."""
    spark = docs.sparkSession
    uri = new_folder(spark, "token-files")
    try:
        return materialize(read_tokens(write_tokens(docs, uri, path), uri), "token-rows")
    finally:
        delete(spark, uri)
