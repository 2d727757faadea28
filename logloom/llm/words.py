"""Words and word n-grams of whole Arrow batches, by numpy on the UTF-8 bytes.

A word class is a table of 256 flags, one per byte. The classes used here treat every byte from 0x80 on as
a word byte, so that working on bytes equals working on characters. Batches are cut at document ends into
chunks of about ``CHUNK_BYTES``, or as asked for; a document is never cut, so an n-gram sees its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_WHITE = [0x20, *range(0x09, 0x0E)]
#: ``[^\x20\x09-\x0D]``
NOT_WHITE = np.ones(256, dtype=bool)
NOT_WHITE[_WHITE] = False
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_rng = np.random.default_rng(20240229)
_BYTE_CODES = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64) | np.uint64(1)
_FOLDED_CODES = _BYTE_CODES.copy()
_FOLDED_CODES[0x41:0x5B] = _BYTE_CODES[0x61:0x7B]
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, min(1 << n.bit_length(), CHUNK_BYTES + 1))
            up, down = (np.full(size, b, dtype=np.uint64) for b in (self.base, self.inverse))
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
            if size > 64 * CHUNK_BYTES:  # one huge document: do not keep its tables
                kept = self.up[:n], self.down[:n]
                self.up, self.down = self.up[: CHUNK_BYTES + 1].copy(), self.down[: CHUNK_BYTES + 1].copy()
                return kept
        return self.up[:n], self.down[:n]


_BYTE_POWERS, _WORD_POWERS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Chunk:
    """Consecutive documents of a batch: byte buffer, word spans, hashes, and the words of each document."""

    first: int  #: row of the first document in the batch
    data: np.ndarray
    doc_bytes: np.ndarray  #: document d has the bytes doc_bytes[d]:doc_bytes[d + 1]
    starts: np.ndarray
    ends: np.ndarray
    doc_words: np.ndarray  #: document d has the words doc_words[d]:doc_words[d + 1]
    hashes: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.doc_bytes) - 1

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), np.diff(self.doc_words))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def words(self, i: int, j: int) -> list[bytes]:
        if i >= j:
            return []
        at = int(self.starts[i])
        text = self.data[at : self.ends[j - 1]].tobytes()
        return [text[s:e] for s, e in zip((self.starts[i:j] - at).tolist(), (self.ends[i:j] - at).tolist())]

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of n words that lies within one document."""
        total = len(self.hashes)
        if total < n:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        doc = self.doc_of_word()
        at = np.flatnonzero(doc[: total - n + 1] == doc[n - 1 :])
        return at, gram_hashes(self.hashes, at, n)


def gram_hashes(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n word hashes from each place in ``at`` on."""
    up, down = _WORD_POWERS.upto(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=total[1:])
    return mixed((total[at + n] - total[at]) * down[at] + np.uint64(n))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null has no bytes."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.empty(0, dtype=np.uint8)
    return data, offsets


def _scan(data: np.ndarray, offsets: np.ndarray, first: int, last: int, word_class: np.ndarray, fold: bool) -> Chunk:
    base = offsets[first]
    data, bounds = data[base : offsets[last]], offsets[first : last + 1] - base
    n = len(data)
    inside = word_class[data]
    before, after = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    if n:
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = bounds[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        before[edges], after[edges - 1] = False, False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    up, down = _BYTE_POWERS.upto(n + 1)
    codes = (_FOLDED_CODES if fold else _BYTE_CODES)[data]
    codes *= up[:n]
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(codes, out=total[1:])
    hashes = mixed((total[ends] - total[starts]) * down[starts])
    return Chunk(first, data, bounds, starts, ends, np.searchsorted(starts, bounds), hashes)


def chunks(column: pa.Array, word_class: np.ndarray, fold: bool, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The documents of a string column in chunks of about ``size`` bytes; ``fold`` treats A-Z as a-z."""
    data, offsets = string_buffers(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield _scan(data, offsets, first, last, word_class, fold)
        first = last


def split_words(text: str | None, word_class: np.ndarray, fold: bool) -> list[bytes]:
    """The words of one text, for small tables and for checks."""
    chunk = next(chunks(pa.array([text or ""]), word_class, fold))
    words = chunk.words(0, len(chunk.starts))
    return [w.lower() for w in words] if fold else words


def spans_union(starts: np.ndarray, length: int | np.ndarray, size: int) -> np.ndarray:
    """Flags of the ``size`` places covered by the intervals that begin at ``starts``."""
    edge = np.zeros(size + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    return np.cumsum(edge[:size]) > 0
