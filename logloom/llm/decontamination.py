"""Benchmark decontamination: a broadcast hash set of test n-grams against every window of the training text.

The benchmark's normalised windows are hashed. Each task keeps that set as a bit table and a sorted array,
hashes the windows of whole documents with numpy, looks them up and compares the words of every hit. The
document side is never shuffled. The broadcast is bounded: windows come in blocks of about ``windows_per_block``, and a
stage holds ``BLOCKS_PER_STAGE`` of them at most. A larger benchmark takes more blocks, each one a further narrow pass over
the same rows, with the rows written to the shared folder and the blocks given up between stages.

A window is ``n`` consecutive words of an item; an item with fewer words, but not none, is one window.
Null texts have no words. An item with a null id counts for hits but not among the items. Repeated rows on
either side are treated one by one; item ids count once. Empty tables give no hits or no rows. Columns of
the documents that clash with the result's names are replaced in ``find_hits`` and kept in ``decontaminate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.storage import blocks_for, staged
from logloom.llm.words import ALNUM, chunks, gram_hashes, spans_union, split_words
from logloom.llm.workers import give_back

WINDOW = 13
WINDOWS_PER_BLOCK = 200_000
BLOCKS_PER_STAGE = 4
#: Bytes of text whose windows are looked up at once.
BYTES_AT_ONCE = 250_000

_SPAN = "array<struct<first:int,last:int>>"
_FOUND = f"n_words long, spans {_SPAN}, items array<string>"
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def benchmark_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """(words, size, item_ids): the distinct windows of the items, words joined by a space."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, sizes = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = split_words(text, ALNUM, fold=True)
                size = min(n, len(words))
                for at in range(len(words) - size + 1 if words else 0):
                    ids.append(item), texts.append(b" ".join(words[at : at + size]).decode()), sizes.append(size)
            columns = [pa.array(ids, pa.string()), pa.array(texts, pa.string()), pa.array(sizes, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["item_id", "words", "size"])

    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.mapInArrow(windows, "item_id string, words string, size int")
    return rows.groupBy("words", "size").agg(F.collect_set("item_id").alias("item_ids"))


class _WindowSet:
    """A block of windows, ready for lookups."""

    def __init__(self, rows: list[tuple[str, int, list[str]]]):
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, list[bytes], list[list[str]]]] = {}
        for size in sorted({r[1] for r in rows}):
            found = [r for r in rows if r[1] == size]
            hashes = np.array([_hash_of(r[0]) for r in found], dtype=np.uint64)
            order = np.argsort(hashes, kind="stable")
            bits = np.zeros(1 << max(16, int(16 * len(found)).bit_length()), dtype=bool)
            bits[hashes & np.uint64(len(bits) - 1)] = True
            self.by_size[size] = (bits, hashes[order], [found[i][0].encode() for i in order], [found[i][2] for i in order])


def _hash_of(words: str) -> int:
    chunk = next(chunks(pa.array([words]), ALNUM, True))
    return int(gram_hashes(chunk.hashes, np.array([0]), len(chunk.hashes))[0])


def _scan_batch(column: pa.Array, windows: _WindowSet) -> tuple[list[int], list[list], list[list[str]]]:
    """Of each document: the number of words, the hit spans in words, the items hit."""
    counts, spans, items = [], [], []
    for chunk in chunks(column, ALNUM, True, BYTES_AT_ONCE):
        n_words = len(chunk.hashes)
        covered = np.zeros(n_words, dtype=bool)
        hit_items: dict[int, set[str]] = {}
        doc = chunk.doc_of_word()
        for size, (bits, hashes, texts, ids) in windows.by_size.items():
            at, grams = chunk.grams(size)
            maybe = np.flatnonzero(bits[grams & np.uint64(len(bits) - 1)])
            low, high = (np.searchsorted(hashes, grams[maybe], side=side).tolist() for side in ("left", "right"))
            confirmed = []
            for start, i, j in zip(at[maybe].tolist(), low, high):
                if i < j:
                    words = b" ".join(chunk.words(start, start + size)).lower()
                    for k in range(i, j):
                        if texts[k] == words:
                            confirmed.append(start)
                            hit_items.setdefault(int(doc[start]), set()).update(ids[k])
            if confirmed:
                covered |= spans_union(np.array(confirmed), size, n_words)
        counts += np.diff(chunk.doc_words).tolist()
        for d in range(chunk.n_docs):
            if d not in hit_items:
                spans.append([])
                items.append([])
                continue
            flags = np.concatenate([[False], covered[chunk.doc_words[d] : chunk.doc_words[d + 1]], [False]])
            edges = np.flatnonzero(flags[1:] != flags[:-1]).tolist()
            spans.append([{"first": a, "last": b - 1} for a, b in zip(edges[::2], edges[1::2])])
            items.append(sorted(hit_items[d]))
    return counts, spans, items


def find_hits(documents: DataFrame, benchmark: DataFrame, n: int = WINDOW, windows_per_block: int = WINDOWS_PER_BLOCK) -> DataFrame:
    """``documents`` with n_words, n_hit, hit_spans (first and last word of each merged run) and hit_items."""
    spark = documents.sparkSession
    windows = staged(benchmark_windows(benchmark, n))
    blocks = blocks_for(windows.count(), windows_per_block)
    out = documents.drop("n_words", "n_hit", "hit_spans", "hit_items").withColumns(
        {"n_words": F.lit(0).cast("long"), "hit_spans": F.array().cast(_SPAN), "hit_items": F.array().cast("array<string>")}
    )
    held = []
    for block in range(blocks):
        if len(held) == BLOCKS_PER_STAGE:
            out = staged(out)
            for shared in held:
                shared.destroy()
            held = []
        rows = windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block).select("words", "size", "item_ids")
        held.append(spark.sparkContext.broadcast(_WindowSet([tuple(r) for r in rows.collect()])))
        out = _with_block(out, held[-1])
    merged = F.aggregate(
        F.array_sort("hit_spans"),
        F.array().cast(_SPAN),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["first"] <= F.element_at(done, -1)["last"] + 1),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["first"].alias("first"), F.greatest(F.element_at(done, -1)["last"], s["last"]).alias("last"))),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    if blocks > 1:
        out = out.withColumn("hit_spans", merged)
    covered = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"] + 1)
    return out.withColumn("hit_items", F.array_sort(F.array_distinct("hit_items"))).withColumn("n_hit", covered)


def _with_block(rows: DataFrame, shared) -> DataFrame:
    """``rows`` with the hits of one more block; only the text goes to Python, and only the hits come back."""

    @F.arrow_udf(_FOUND)
    def scan(texts: pa.Array) -> pa.Array:
        counts, spans, items = _scan_batch(texts, shared.value)
        give_back()
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))], names=["n_words", "spans", "items"])

    found = "found"
    while found in rows.columns:
        found += "_"
    hits = {"n_words": F.col(f"{found}.n_words"), "hit_spans": F.concat("hit_spans", f"{found}.spans"), "hit_items": F.concat("hit_items", f"{found}.items")}
    return rows.withColumn(found, scan(F.col("text").cast("string"))).withColumns(hits).drop(found)


def is_contaminated(n_words: str = "n_words", n_hit: str = "n_hit"):
    """At least one hit word, and a twentieth of the words or more."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def decontaminate(documents: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """The documents, all columns as they came, without the contaminated ones."""
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.col("text").cast("string").alias("text"))
    return find_hits(packed, benchmark, n).where(~is_contaminated()).select("row.*")
