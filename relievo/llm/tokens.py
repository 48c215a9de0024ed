"""Token counts by the whole-token shortcut.

Before any text is read, every vocabulary string is encoded on its own; those that
are one pre-token and come back as one token are proven whole. Pre-tokens found
among them count directly. Only the rest are merged by the library, once for each
distinct pre-token that a worker meets.

Letters, digits, spaces and other signs are told apart by a pattern up to U+024F.
Beyond, where Unicode tables differ by version, the library itself is asked for
the class of each character that occurs, once, and a text is split where a text of
the same classes would be. A text with a special string goes to the library whole.
So counts always equal the library's.

Defined cases: a null text is empty and has no tokens; a null id is kept; repeated
rows are counted once each; a text of exactly ``limit`` tokens is not over it; an
empty table gives an empty result; texts are taken whole, very long ones alone;
other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from relievo.plans.text import text_or_empty

#: Letters and digits below this point have the same class in all Unicode tables in use.
_SETTLED = 0x250
#: Distinct pre-tokens that a worker remembers before it forgets them all.
MEMORY = 1 << 20


def _klass(kind: str) -> str:
    points = [i for i in range(_SETTLED) if unicodedata.category(chr(i))[0] == kind]
    return "".join(re.escape(chr(i)) for i in points)


LETTER, NUMBER = _klass("L"), _klass("N")
_SPACES = "\t\n\x0b\x0c\r \x85\xa0"
#: Classes in doubt, and white space that regular expressions disagree on.
UNSETTLED = re.compile(f"[^\x00-\x1b\x20-{chr(_SETTLED - 1)}‐-‧‰-⁞€]")
_SPLIT = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{_SPACES}{LETTER}{NUMBER}]+|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)


def _byte_chars() -> dict[int, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(plain))}


_BYTE_CHARS = _byte_chars()


@cache
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


class _Classes(dict):
    """For each character in doubt one of the same class that is not, as a table for ``str.translate``."""

    def __init__(self, path: str):
        super().__init__()
        self.pieces = tokenizer(path).pre_tokenizer.pre_tokenize_str

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if not UNSETTLED.match(c):
            self[code] = c
        else:  # between two of its class a character makes no piece of its own
            self[code] = next((like for like in "é²§" if len(self.pieces(like + c + like)) == 1), "\xa0")
        return self[code]


@cache
def classes(path: str) -> _Classes:
    return _Classes(path)


def pre_tokens(path: str, text: str) -> list[str]:
    """The library's pieces of a text without special strings."""
    if not UNSETTLED.search(text):
        return _SPLIT.findall(text)
    return [text[m.start() : m.end()] for m in _SPLIT.finditer(text.translate(classes(path)))]


@cache
def specials(path: str) -> re.Pattern | None:
    """A pattern for the tokenizer's special strings."""
    names = [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]
    return re.compile("|".join(map(re.escape, sorted(names, key=len, reverse=True)))) if names else None


@cache
def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that are one pre-token and encode alone as one token."""
    tok = tokenizer(path)
    size = tok.get_vocab_size(with_added_tokens=False)
    strings = tok.decode_batch([[i] for i in range(size)], skip_special_tokens=False)
    usable = [s for s in strings if s and "\ufffd" not in s and pre_tokens(path, s) == [s]]
    encoded = tok.encode_batch(usable, add_special_tokens=False)
    return frozenset(s for s, e in zip(usable, encoded, strict=True) if len(e.ids) == 1)


def _counter(path: str):
    """A function from a list of texts to their token counts."""
    tok, special = tokenizer(path), specials(path)
    merge = tok.model.tokenize
    known = dict.fromkeys(whole_tokens(path), 1)
    whole = len(known)

    def count(texts: list[str]) -> list[int]:
        if len(known) > whole + MEMORY:
            for piece in list(known)[whole:]:
                del known[piece]
        out = []
        pieces = [None if special and special.search(t) else pre_tokens(path, t) for t in texts]
        new = [p for p in {p for ps in pieces if ps for p in ps} if p not in known]
        if new:
            known.update((p, len(merge(p.encode().decode("latin-1").translate(_BYTE_CHARS)))) for p in new)
        for t, ps in zip(texts, pieces, strict=True):
            out.append(sum(map(known.__getitem__, ps)) if ps is not None else len(tok.encode(t, add_special_tokens=False)))
        return out

    return count


def slices(texts: list[str], chars: int = 1 << 20) -> Iterator[list[str]]:
    """Runs of texts of about so many characters, a longer text alone."""
    held, run = 0, []
    for t in texts:
        if run and held + len(t) > chars:
            yield run
            held, run = 0, []
        run.append(t)
        held += len(t)
    if run:
        yield run


_COUNTED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def _count(path: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n = [k for part in slices(texts) for k in count(part)]
            sizes = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(n, pa.int64()), pa.array([k > limit for k in n])], schema=_COUNTED
            )

    return run


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return texts.mapInArrow(_count(path, limit), "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
