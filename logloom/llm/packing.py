"""Harmonic packing of token sequences.

A document's tokens, closed by an end token, are cut into pieces. Piece lengths fall into reciprocal-capacity
classes: class k holds the lengths from ``capacity // (k + 1) + 1`` to ``capacity // k``, and a sequence of
class k takes k pieces. Whole capacities are class 1. What is left of a document is cut at the largest exact
class lengths, ``capacity // k``, so that a full sequence wastes fewer than k tokens; the last cut leaves at
most ``tail`` tokens, which are kept in one piece.

Every task fills its own classes, independently of the others, and in memory that the capacity bounds: an open
sequence of class k has fewer than k pieces. At its end the open sequences are laid one after the other and
cut at the capacity, the last rest at powers of two, which need no padding. Nothing is shuffled, so a large
source or a very long document costs only its own tokens.

A null text is an empty one and has the end token alone. Repeated rows are packed each on its own. An empty
table gives no rows. Other columns are ignored. Sequence ids are unique over the tasks: partition number, then
a counter.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.workers import lean

CAPACITY = 1024
TAIL = 64
END_ID = 0
#: Pieces that a task holds before it hands them on.
PIECES_AT_ONCE = 5_000

_SCHEMA = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, token_ids binary"


#: Characters below this are of the same class (letter, number, space, other) in every Unicode version.
_COMMON = "\u0250"


def _bytes_of_symbols() -> dict[str, int]:
    """The printable character by which byte-level BPE files write each byte, inverted."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return symbols | {chr(256 + i): b for i, b in enumerate(others)}


def _fast_encoding(path: str):
    """The file's vocabulary for tiktoken, whose ranks are the ids, without the special tokens."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {t["content"] for t in content["added_tokens"]}
    symbols = _bytes_of_symbols()
    ranks = {bytes(symbols[c] for c in token): rank for token, rank in content["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), special


class TokenIds:
    """Token ids of texts by a byte-level BPE file of the ``tokenizers`` library.

    The ids come from tiktoken with the file's vocabulary, which gives the same ids five times faster. Parts of
    a text with characters of rarer scripts or with a special token's text go through ``tokenizers`` itself.
    """

    _by_path: dict[str, TokenIds] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.fast, self.special = _fast_encoding(path)

    @classmethod
    def of(cls, path: str) -> TokenIds:
        """One for each worker process, kept over its tasks."""
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self._is_common(text):
            return self._packed(self.fast.encode_ordinary(text))
        return b"".join(self._part(p) for p in regular_parts(text))

    def _is_common(self, text: str) -> bool:
        return not text or (max(text) < _COMMON and not any(s in text for s in self.special))

    def _part(self, part: str) -> bytes:
        if self._is_common(part):
            return self._packed(self.fast.encode_ordinary(part))
        return self._packed(self.tokenizer.encode(part, add_special_tokens=False).ids)

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return np.array(ids, dtype="<u4").tobytes()


def regular_parts(text: str, size: int = 1 << 12) -> Iterator[str]:
    """The text in parts of about ``size`` characters, cut before a single space between two other characters.

    No token of the pattern reaches over such a place, so the ids of a text are the ids of its parts.
    """
    at = 0
    while at < len(text):
        cut = at + size
        while cut < len(text) and not (text[cut] == " " and not text[cut - 1].isspace() and cut + 1 < len(text) and not text[cut + 1].isspace()):
            cut += 1
        yield text[at:cut]
        at = cut


def piece_lengths(n: int, capacity: int = CAPACITY, tail: int = TAIL) -> list[int]:
    """How a document of n tokens is cut."""
    lengths = [capacity] * (n // capacity)
    rest = n % capacity
    while rest > tail:
        cut = capacity // -(-capacity // rest)  # the largest class length that fits
        lengths.append(cut)
        rest -= cut
    return lengths + [rest] * (rest > 0)


class _Packer:
    """Open sequences of one task."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list[tuple]] = {}
        self.done: list[tuple] = []

    def add(self, piece: tuple) -> None:
        """piece: (doc_id, start, ids, doc_tokens)"""
        k = self.capacity // (len(piece[2]) // 4)
        pieces = self.open.setdefault(k, [])
        pieces.append(piece)
        if len(pieces) == k:
            self._close(pieces)
            self.open[k] = []

    def _close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc_id, start, ids, doc_tokens in pieces:
            self.done.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), doc_tokens, self.next_id, at, ids))
            at += len(ids) // 4
        self.next_id += 1

    def finish(self) -> None:
        """Lays the open sequences in a row and cuts it at the capacity, the last part at powers of two."""
        pieces = [p for k in sorted(self.open) for p in self.open[k]]
        left = sum(len(p[2]) // 4 for p in pieces)
        room, row = 0, []
        for doc_id, start, ids, doc_tokens in pieces:
            while ids:
                if not room:
                    self._close(row) if row else None
                    row, room = [], min(self.capacity, 1 << (left.bit_length() - 1))
                n = min(room, len(ids) // 4)
                row.append((doc_id, start, ids[: 4 * n], doc_tokens))
                ids, start, room, left = ids[4 * n :], start + n, room - n, left - n
        self._close(row) if row else None
        self.open = {}

    def take(self) -> list[tuple]:
        done, self.done = self.done, []
        return done


def pack(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, tail: int = TAIL, with_ids: bool = True) -> DataFrame:
    """One row per piece, with its token ids (little-endian unsigned 32-bit) unless ``with_ids`` is false.

    The capacity must be a power of two, so that any rest can be cut into sequences that need no padding.
    """
    if capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    end = np.array([END_ID], dtype="<u4").tobytes()
    id_type = documents.schema["doc_id"].dataType.simpleString()
    schema = _SCHEMA.format(id=id_type)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = TokenIds.of(tokenizer_path)
        packer = _Packer(capacity, TaskContext.get().partitionId() << 40)
        id_kind = None
        for batch in batches:
            id_kind = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = tokens.encode(text.as_py() or "") + end
                start = 0
                for n in piece_lengths(len(ids) // 4, capacity, tail):
                    packer.add((doc_id, start, ids[4 * start : 4 * (start + n)], len(ids) // 4))
                    start += n
                if len(packer.done) >= PIECES_AT_ONCE:
                    yield _rows(packer.take(), id_kind, with_ids)
        packer.finish()
        if packer.done:
            yield _rows(packer.take(), id_kind, with_ids)

    rows = documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(lean(packed), schema)
    return rows if with_ids else rows.drop("token_ids")


def _rows(done: list[tuple], id_kind: pa.DataType, with_ids: bool) -> pa.RecordBatch:
    columns = list(zip(*done))
    arrays = [pa.array(columns[0], id_kind)] + [pa.array(c, pa.int64()) for c in columns[1:7]]
    arrays.append(pa.array(columns[7] if with_ids else [None] * len(done), pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "token_ids"])
