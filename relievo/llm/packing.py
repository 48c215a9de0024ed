"""Harmonic packing of tokenised documents into sequences of 4096 tokens.

A document of n tokens is of class ``4096 // n``: its length lies between two
neighbouring reciprocals of the capacity. A worker keeps one open bin for each
class and closes it with its class's fixed number of documents; it needs to know
nothing of other workers, so there is no exchange. What a closed bin has left
over is filled from a stream of fillers, which are cut where the bin ends: what
documents over the capacity leave after their full sequences, documents of at most
SMALL tokens, which have no bins, and, while a bin waits and there are no others,
the next document. So documents with bins stay whole, and padding is left to a
worker's last documents only: these are cut into full sequences too, and the last
tokens into sequences whose lengths are powers of two, which need none.

Defined cases: a null text is empty and has its end token only; a null id is
kept; repeated rows are packed once each; documents of one length are taken as
they come; an empty table gives an empty result; texts are taken whole, very long
ones alone; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relievo.llm.tokens import _BYTE_CHARS, _SETTLED, LETTER, NUMBER, UNSETTLED, slices, specials, tokenizer
from relievo.plans.text import text_or_empty

CAPACITY = 4096
#: Documents of at most so many tokens have no bins of their own.
SMALL = 64
#: Sequences that a worker may number.
_SEQUENCES = 1 << 40
END_ID = 2
#: Distinct pre-tokens that a worker remembers before it forgets them all.
MEMORY = 1 << 18
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^\\s{LETTER}{NUMBER}]+")
#: Lower-casing these gives several characters or one that is not settled.
_ODD_CASE = re.compile("[" + "".join(chr(i) for i in range(0x100, _SETTLED) if len(chr(i).lower()) > 1 or ord(chr(i).lower()) >= _SETTLED) + "]")


def encoder(path: str):
    """A function from a text to its ids as little-endian 32-bit bytes, without the end id."""
    tok, special = tokenizer(path), specials(path)
    merge, known = tok.model.tokenize, {}
    split = _SPLIT.findall

    def encode(text: str) -> bytes:
        if UNSETTLED.search(text) or _ODD_CASE.search(text) or special and special.search(text):
            return np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        pieces = split(text.lower())
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


@dataclass
class _Piece:
    """Tokens ``[at, end)`` of a document, whose ids are all in ``ids``."""

    doc: int | None
    ids: memoryview
    at: int
    end: int

    @property
    def size(self) -> int:
        return self.end - self.at

    def cut(self, size: int) -> _Piece:
        """The first ``size`` tokens, which the piece loses."""
        first = _Piece(self.doc, self.ids, self.at, min(self.end, self.at + size))
        self.at = first.end
        return first


class Packer:
    """One worker's bins; ``rows`` collects the pieces that are placed."""

    def __init__(self, part: int):
        self.rows: list[tuple] = []
        self.next_id = part * _SEQUENCES
        self.open: dict[int, list[_Piece]] = {}
        self.waiting: list[tuple[int, list[_Piece]]] = []  # bins with their classes, closed but not filled
        self.fillers: deque[_Piece] = deque()
        self.filler_tokens = 0

    def add(self, doc: int | None, ids: bytes) -> None:
        rest = _Piece(doc, memoryview(ids), 0, len(ids) // 4)
        whole = rest.size <= CAPACITY
        while rest.size >= CAPACITY:
            self._place([(int(whole), rest.cut(CAPACITY))])
        if not rest.size:
            return
        if self.waiting or rest.at or rest.size <= SMALL:
            self.fillers.append(rest)
            self.filler_tokens += rest.size
        else:
            kind = CAPACITY // rest.size
            bin_ = self.open.setdefault(kind, [])
            bin_.append(rest)
            if len(bin_) == kind:
                self.waiting.append((kind, self.open.pop(kind)))
        while self.waiting and self.filler_tokens >= CAPACITY - sum(p.size for p in self.waiting[0][1]):
            kind, bin_ = self.waiting.pop(0)
            self._place([(kind, p) for p in bin_] + self._filled(CAPACITY - sum(p.size for p in bin_)))
        while not self.waiting and self.filler_tokens >= CAPACITY:
            self._place(self._filled(CAPACITY))

    def finish(self) -> None:
        """Place what is left: full sequences, then one for each binary digit of the rest."""
        left = [p for _, b in self.waiting for p in b] + [p for k in sorted(self.open) for p in self.open[k]]
        self.waiting, self.open = [], {}
        self.fillers.extendleft(reversed(left))
        self.filler_tokens += sum(p.size for p in left)
        while self.filler_tokens:
            self._place(self._filled(min(CAPACITY, 1 << (self.filler_tokens.bit_length() - 1))))

    def _filled(self, size: int) -> list[tuple[int, _Piece]]:
        """Pieces of so many tokens from the stream of fillers."""
        self.filler_tokens -= size
        out = []
        while size:
            piece = self.fillers[0].cut(size)
            out.append((0, piece))
            size -= piece.size
            if not self.fillers[0].size:
                self.fillers.popleft()
        return out

    def _place(self, pieces: list[tuple[int, _Piece]]) -> None:
        offset = 0
        for kind, p in pieces:
            self.rows.append((p.doc, p.at, p.size, zlib.crc32(p.ids[4 * p.at : 4 * p.end]), len(p.ids) // 4, self.next_id, offset, kind))
            offset += p.size
        self.next_id += 1


_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, harmonic bigint"
_PIECES_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in _PIECES.split(", ")])


def _pack(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(path), Packer(TaskContext.get().partitionId())
        end = np.array([end_id], "<u4").tobytes()

        def placed() -> Iterator[pa.RecordBatch]:
            if packer.rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*packer.rows)], schema=_PIECES_ARROW)
                packer.rows = []

        for batch in batches:
            ids = iter(batch.column("doc_id").to_pylist())
            for run_of in slices(batch.column("text").to_pylist()):
                for text in run_of:
                    packer.add(next(ids), encode(text) + end)
                yield from placed()
        packer.finish()
        yield from placed()

    return run


def pack(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, harmonic)`` of every piece.

    ``harmonic`` is the class of a document that lies whole in a bin of its class,
    and 0 for fillers. A task's pieces depend on its own rows alone.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return texts.mapInArrow(_pack(path, end_id), _PIECES)
