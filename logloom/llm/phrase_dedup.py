"""Removal of recurring passages: recurring windows are confirmed, compiled into automata, and located.

A window is 35 consecutive words of one document. Words covered by a window whose words also start anywhere
else, in the same document too, are removed; the first occurrence is no exception.

1. Anchors. Every window holds 18 runs of 18 words; the one with the smallest hash is its anchor, so equal windows
   have equal anchors. One pass counts anchor places (about one in ten words); those found once are dropped.
2. Passages. A second pass counts the windows whose anchor recurs, as told by a bit filter of fixed size. Windows
   found twice or more are confirmed by a grouped count, whatever the filter let through. A third pass, with a
   second filter, lists the places of confirmed windows, and a join with the confirmed ones makes that exact.
3. Automata. The confirmed places of each document are joined to its text. The documents of a chunk of about a
   megabyte form a shard: their recurring passages are compiled into one Aho-Corasick automaton, over characters
   that stand for words, and all documents of the chunk are streamed through it to locate every occurrence. A shard
   holds no more than its own documents' passages, so the work grows with the corpus and not with its square.

A passage in very many documents is counted before it is shuffled, and the join of places is on window hashes,
where adaptive execution splits large partitions. Null and empty texts have no words. Equal rows count as two
documents, so their windows recur; their places are gathered once for all of them, before and after the shuffle. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.bit_filter import broadcast_filter
from logloom.llm.storage import staged
from logloom.llm.words import NOT_WHITE, Chunk, chunks, gram_hashes, mixed, spans_union

WINDOW = 35
ANCHOR = 18
#: Words of a chunk are written as one character each up to this many distinct ones, else as two.
_ONE_CHARACTER = 1_000_000


def window_anchors(chunk: Chunk, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, places, hashes): each window's first word, and the place and hash of its anchor.

    Of equal hashes the leftmost counts, so equal windows have their anchors at equal distances.
    """
    total = len(chunk.hashes)
    if total < window:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    runs = gram_hashes(chunk.hashes, np.arange(total - anchor + 1), anchor)
    places, width, wanted = np.arange(len(runs)), 1, window - anchor + 1
    while width < wanted:  # places[i]: leftmost smallest of runs[i:i + width]
        step = min(width, wanted - width)
        left, right = places[:-step], places[step:]
        places, width = np.where(runs[left] <= runs[right], left, right), width + step
    doc = chunk.doc_of_word()
    starts = np.flatnonzero(doc[: total - window + 1] == doc[window - 1 :])
    places = places[starts]
    return starts, places, runs[places]


def window_keys(chunk: Chunk, starts: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """96 bits for each window: a long and an int."""
    second = mixed(gram_hashes(mixed(chunk.hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts, window))
    return gram_hashes(chunk.hashes, starts, window).view(np.int64), (second >> np.uint64(32)).astype(np.uint32).view(np.int32)


def recurring_anchors(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(anchor): the anchor hashes that occur at two places or more."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0), NOT_WHITE, fold=False):
                _, places, hashes = window_anchors(chunk, window)
                _, first = np.unique(places, return_index=True)
                values, counts = np.unique(hashes[first], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(np.minimum(counts, 2), pa.int64())], names=["anchor", "n"])

    found = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(counted, "anchor long, n long")
    return found.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")


def _candidates(column: pa.Array, anchors, window: int) -> Iterator[tuple[Chunk, np.ndarray, np.ndarray, np.ndarray]]:
    """(chunk, starts, keys, checks) of the windows whose anchor may recur."""
    for chunk in chunks(column, NOT_WHITE, fold=False):
        starts, _, hashes = window_anchors(chunk, window)
        starts = starts[anchors.value.may_have(hashes)]
        if len(starts):
            yield chunk, starts, *window_keys(chunk, starts, window)


def recurring_windows(keyed: DataFrame, anchors, window: int) -> DataFrame:
    """(key, check) of the windows that occur twice or more."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, keys, checks in _candidates(batch.column(2), anchors, window):
                order = np.lexsort((checks, keys))
                keys, checks = keys[order], checks[order]
                first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1])]))
                counts = np.diff(np.append(first, len(keys)))
                yield pa.RecordBatch.from_arrays([pa.array(keys[first]), pa.array(checks[first]), pa.array(np.minimum(counts, 2), pa.int64())], names=["key", "check", "n"])

    found = keyed.mapInArrow(counted, "key long, check int, n long")
    return found.groupBy("key", "check").agg(F.sum("n").alias("n")).where("n > 1").select("key", "check")


def _places(keyed: DataFrame, anchors, confirmed, window: int) -> DataFrame:
    """(key, check, row_key, start) of the windows that pass both filters; ``start`` counts words in the document."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).to_numpy(zero_copy_only=False)
            for chunk, starts, keys, checks in _candidates(batch.column(2), anchors, window):
                passed = confirmed.value.may_have(keys.view(np.uint64))
                starts = starts[passed]
                doc = chunk.doc_of_word()[starts]
                own = (starts - chunk.doc_words[doc]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(keys[passed]), pa.array(checks[passed]), pa.array(rows[chunk.first + doc]), pa.array(own)], names=["key", "check", "row_key", "start"])

    return keyed.mapInArrow(listed, "key long, check int, row_key long, start int")


def _located(chunk: Chunk, places: list[np.ndarray], window: int) -> np.ndarray:
    """Flags of the chunk's words that a recurring window covers.

    places: of each document, the confirmed windows as ``start << 32 | check``.
    """
    total = len(chunk.hashes)
    covered = np.zeros(total, dtype=bool)
    own = [(d, np.unique(places[d])) for d in range(chunk.n_docs) if len(places[d])]
    if not own:
        return covered
    distinct, codes = np.unique(chunk.hashes, return_inverse=True)
    width = 1 if len(distinct) < _ONE_CHARACTER else 2
    text = _as_text(codes, width)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for d, found in own:
        starts = (found >> 32) + chunk.doc_words[d]
        starts = starts[window_keys(chunk, starts, window)[1] == found.astype(np.uint32).view(np.int32)]
        for first, last in _runs(starts):
            for start in {*range(first, last, window), last}:
                automaton.add_word(text[width * start : width * (start + window)])
    if len(automaton):
        automaton.make_automaton()
        hits = []
        for d in range(chunk.n_docs):
            base = int(chunk.doc_words[d])
            ends = [end for end, _ in automaton.iter(text[width * base : width * int(chunk.doc_words[d + 1])]) if (end + 1) % width == 0]
            hits += [base + (end + 1) // width - window for end in ends]
        covered = spans_union(np.array(hits, dtype=np.int64), window, total)
    return covered


def _lists(column: pa.Array) -> list[np.ndarray]:
    """The lists of a column of longs; a null is an empty one."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.split(column.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)[:-1])


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of the runs of consecutive numbers."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.concatenate([[0], cuts + 1])].tolist(), starts[np.concatenate([cuts, [len(starts) - 1]])].tolist()))


def _as_text(codes: np.ndarray, width: int) -> str:
    """A character (or two) for each word; characters reserved for surrogates are left out."""
    if width == 2:
        codes = np.stack([codes >> 16, 0x8000 + (codes & 0x3FFF) + ((codes >> 14) & 3) * 0x10000], axis=1).ravel()
    codes = codes + 1
    codes = np.where(codes >= 0xD800, codes + 0x800, codes)
    return codes.astype("<u4").tobytes().decode("utf-32-le")


def _kept_texts(chunk: Chunk, covered: np.ndarray) -> list[str]:
    """The words left of each document, joined by one space."""
    kept = np.flatnonzero(~covered)
    first, last = chunk.starts[kept], chunk.ends[kept]
    limit = np.minimum(last + 1, chunk.doc_bytes[1:][chunk.doc_of_word()[kept]])
    edge = np.zeros(len(chunk.data) + 1, dtype=np.int8)
    edge[first] += 1
    edge[limit] -= 1
    chosen = np.cumsum(edge[:-1], dtype=np.int8) > 0
    out = np.where(NOT_WHITE[chunk.data], chunk.data, np.uint8(0x20))[chosen]
    cuts = np.concatenate([[0], np.cumsum(chosen)])[chunk.doc_bytes].tolist()
    return [out[a:b].tobytes().decode().removesuffix(" ") for a, b in zip(cuts, cuts[1:])]


def remove_recurring(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, removed (spans of words) and text, the kept words joined by one space."""
    text = F.col("text").cast("string")
    keyed = documents.select("doc_id", F.xxhash64("doc_id", text).alias("row_key"), text.alias("text"))
    anchors = broadcast_filter(recurring_anchors(documents, window))
    confirmed = staged(recurring_windows(keyed, anchors, window))
    found = _places(keyed, anchors, broadcast_filter(confirmed.select("key")), window)
    packed = F.expr("shiftleft(cast(start AS bigint), 32) | (cast(check AS bigint) & 4294967295)")
    # equal rows share a key and list the same places: a set is as long as one row's list, however many they are
    places = found.join(confirmed, ["key", "check"]).groupBy("row_key").agg(F.collect_set(packed).alias("places"))
    joined = keyed.join(places, "row_key", "left").select("doc_id", "text", "places")
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1), NOT_WHITE, fold=False):
                rows = batch.slice(chunk.first, chunk.n_docs)
                covered = _located(chunk, _lists(rows.column(2)), window)
                spans = [[{"first": a, "last": b} for a, b in _runs(np.flatnonzero(covered[i:j]))] for i, j in zip(chunk.doc_words[:-1], chunk.doc_words[1:])]
                gone = np.concatenate([[0], np.cumsum(covered)])[chunk.doc_words]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.diff(chunk.doc_words), pa.int64()), pa.array(np.diff(gone), pa.int64()), pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))), pa.array(_kept_texts(chunk, covered), pa.string())],
                    names=["doc_id", "n_words", "n_removed", "removed", "text"],
                )

    return joined.mapInArrow(removed, f"doc_id {id_type}, n_words long, n_removed long, removed array<struct<first:int,last:int>>, text string")
