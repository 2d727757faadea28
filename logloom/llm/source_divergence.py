"""How the sources of a language differ in their use of words, by counts over whole documents.

Token-start pointer sort: a task lays its texts one after the other in an Arrow buffer and takes a pointer to the first byte
of every word. The pointers of a shard (some ``SHARD_BYTES`` of text) are sorted by multikey quicksort over slices of
eight bytes: sorted by one slice, then every run of equal slices whose words go on is sorted by the next. Runs of equal words
give how many documents of each (language, source) have the word and how often. These rows, few against the words, are
what is shuffled; their sums are the corpus counts.

A word is a run of letters and non-ASCII characters, A-Z in lower case. A language keeps the words of at least
``LEAST_DOCS`` of its documents. With N the occurrences of a group's kept words and V their number, a word has
p = 1 + floor(SCALE * (count + 1) / (N + V)) in the group, whether it occurs there or not. The difference of p from
q is floor((p - q)^2 / q). All of it is exact: p by decimals, differences by 64-bit numbers.

- ``pair``: a source against each other source of the language, summed over all kept words.
- ``term``: the words that a source uses more than its language, the ``TOP_TERMS`` most different ones.

Pairs are summed in blocks: sources are dealt to blocks of some ``BLOCK_SOURCES``, words to buckets of some
``BUCKET_ROWS`` counts. A task takes two blocks and one bucket at a time and gives one sum for each pair of sources; words that neither
block has need no row, as they all give the same difference. So neither a large language, a large source
nor a frequent word gathers in one task. The ranking of words keeps each task's first ones before it shuffles.

Null texts, languages and sources are empty strings. Sources without words count as groups. A language of one source has no
pairs. Repeated rows are documents of their own. An empty table gives no rows. Other columns are not looked at, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.storage import blocks_for, staged
from logloom.llm.words import string_buffers

LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
SHARD_BYTES = 4 << 20
BLOCK_SOURCES = 64
BUCKET_ROWS = 10_000
GROUPS_PER_FILE = 20_000
SLICE = 8

#: ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]``
LETTERS = np.zeros(256, dtype=bool)
LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
#: The first k bytes of a slice, for k = 0..8.
_FIRST = np.array([((1 << 64) - 1) ^ ((1 << (64 - 8 * k)) - 1) for k in range(SLICE + 1)], dtype=np.uint64)

COUNTS = "lang string, source string, term string, n_docs long, n long"


class Shard:
    """The words of some documents: lower-case bytes, and for each word its start, length and document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        base = offsets[0]
        data, bounds = data[base : offsets[-1]], offsets - base
        inside = LETTERS[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[bounds] = True
        before = np.zeros(len(data), dtype=bool)
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.starts, self.lengths = starts, ends - starts
        self.docs = np.searchsorted(bounds, starts, side="right") - 1
        self.bytes = np.concatenate([_LOWER[data], np.zeros(SLICE, dtype=np.uint8)])

    def slices(self, words: np.ndarray, depth: int) -> np.ndarray:
        """The bytes of the words from ``depth`` on as one big-endian number each, zero after a word's end."""
        at = self.starts[words] + depth
        raw = np.lib.stride_tricks.sliding_window_view(self.bytes, SLICE)[at].view(">u8").ravel().astype(np.uint64)
        return raw & _FIRST[np.minimum(self.lengths[words] - depth, SLICE)]

    def sorted_runs(self) -> tuple[np.ndarray, np.ndarray]:
        """(words in the order of their bytes, place of the first of each run of equal words)."""
        order = np.arange(len(self.starts))
        head = np.zeros(len(order), dtype=bool)
        head[:1] = True
        places, depth = np.arange(len(order)), 0  # places of the runs not yet told apart
        while len(places):
            run = np.cumsum(head[places])
            words = order[places]
            key = self.slices(words, depth)
            by = np.argsort(key) if depth == 0 else np.lexsort((key, run))
            words, key, run = words[by], key[by], run[by]
            order[places] = words
            new = np.ones(len(places), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (run[1:] != run[:-1])
            head[places] |= new
            depth += SLICE
            # a run goes on if a word of it does; one that ends here has zero as its next slice
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(places)))
            goes_on = np.logical_or.reduceat(self.lengths[words] > depth, first) & (size > 1)
            places = places[np.repeat(goes_on, size)]
        return order, np.flatnonzero(head)

    def word(self, i: int) -> str:
        return self.bytes[self.starts[i] : self.starts[i] + self.lengths[i]].tobytes().decode()


def shard_counts(langs: pa.Array, sources: pa.Array, texts: pa.Array) -> pd.DataFrame:
    """``COUNTS`` of some documents: a row for each word and (language, source) that has it."""
    shard = Shard(*string_buffers(texts))
    order, heads = shard.sorted_runs()
    if not len(heads):
        return pd.DataFrame({"lang": [], "source": [], "term": [], "n_docs": [], "n": []})
    groups = pd.DataFrame({"lang": langs.to_pylist(), "source": sources.to_pylist()})
    group_of_doc, names = groups.groupby(["lang", "source"], sort=False).ngroup().to_numpy(), groups.drop_duplicates()
    term = np.zeros(len(order), dtype=np.int64)
    term[heads[1:]] = 1
    term = np.cumsum(term)
    in_docs, n = np.unique(term * len(group_of_doc) + shard.docs[order], return_counts=True)
    key = in_docs // len(group_of_doc) * len(names) + group_of_doc[in_docs % len(group_of_doc)]
    keys, at, n_docs = np.unique(key, return_inverse=True, return_counts=True)
    total = np.zeros(len(keys), dtype=np.int64)
    np.add.at(total, at, n)
    words = np.array([shard.word(i) for i in order[heads].tolist()], dtype=object)
    group = keys % len(names)
    return pd.DataFrame(
        {"lang": names["lang"].to_numpy()[group], "source": names["source"].to_numpy()[group], "term": words[keys // len(names)], "n_docs": n_docs, "n": total}
    )


def _shards(batches: Iterator[pa.RecordBatch], shard_bytes: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches cut and gathered to about ``shard_bytes`` of text; a document is never cut."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        _, offsets = string_buffers(batch.column(2))
        first = 0
        while first < len(batch):
            last = int(np.searchsorted(offsets, offsets[first] + shard_bytes - size, side="right")) - 1
            last = min(max(last, first + (not held)), len(batch))
            if last > first:
                held.append(batch.slice(first, last - first))
                size += int(offsets[last] - offsets[first])
            if last < len(batch):
                yield held
                held, size = [], 0
            first = last
    if held:
        yield held


def term_counts(documents: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(lang, source, term, n_docs, n): documents with the word and its occurrences, for every group that has it."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _shards(batches, shard_bytes):
            columns = [pa.concat_arrays([b.column(i) for b in held]) for i in range(3)]
            found = shard_counts(*columns)
            for at in range(0, len(found), 100_000):
                kinds = [pa.string()] * 3 + [pa.int64()] * 2
                part = found.iloc[at : at + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(part[c], k) for c, k in zip(part, kinds)], names=list(part))

    counts = documents.select(*_text_columns("lang", "source", "text")).mapInArrow(counted, COUNTS)
    return counts.groupBy("lang", "source", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n"))


def _text_columns(*names: str) -> list[Column]:
    return [F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in names]


def _share(count: Column, total: Column, terms: Column) -> Column:
    """p of a word with this count; NULL without kept words."""
    numerator = (count + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = (total + terms).cast("decimal(19,0)")
    return 1 + F.when(below > 0, F.call_function("div", numerator, below))


def _difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


class Audit:
    """The corpus tables of one audit, each written once to the shared folder."""

    def __init__(self, documents: DataFrame, least_docs: int = LEAST_DOCS, shard_bytes: int = SHARD_BYTES):
        counts = staged(term_counts(documents, shard_bytes))
        words = counts.groupBy("lang", "term").agg(F.sum("n_docs").alias("lang_docs"), F.sum("n").alias("lang_n"))
        words = staged(words.where(F.col("lang_docs") >= least_docs))
        #: (lang, source, term, n, lang_n) of the kept words
        self.kept = staged(counts.join(words.select("lang", "term", "lang_n"), ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"))
        totals = self.kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("n_rows"))
        of_lang = words.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
        groups = documents.select(*_text_columns("lang", "source")).distinct()
        groups = staged(groups.join(totals, ["lang", "source"], "left").fillna(0, ["total", "n_rows"]))
        sizes = groups.groupBy("lang").agg(F.count("*").alias("sources"), F.sum("n_rows").alias("lang_rows"))
        numbers = sizes.join(of_lang, "lang", "left").fillna(0, ["terms", "lang_total"])
        rest = _share(F.lit(0), F.col("total"), F.col("terms"))
        #: (lang, source, total, n_rows, sources, lang_rows, terms, lang_total, rest): rest is p of a word that the source does not have
        self.groups = staged(groups.join(numbers, "lang").withColumn("rest", rest), blocks_for(groups.count(), GROUPS_PER_FILE))

    def shares(self) -> DataFrame:
        """The kept words of each source with p and, as q, the language's."""
        p = _share(F.col("n"), F.col("total"), F.col("terms"))
        q = _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
        return self.kept.join(self.groups, ["lang", "source"]).withColumns({"p": p, "q": q})

    def top_terms(self, top: int = TOP_TERMS) -> DataFrame:
        """(lang, source, item, value, rank) of the words that a source uses more than its language."""
        found = self.shares().where("p > q").select("lang", "source", F.col("term").alias("item"), _difference(F.col("p"), F.col("q")).alias("value"))
        return _ranked(found).where(F.col("rank") <= top)

    def pairs(self, block_sources: int = BLOCK_SOURCES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
        """(lang, source, item, value, rank): each source against each other source of its language."""
        blocks = F.ceil(F.col("sources") / block_sources).cast("int")
        buckets = F.greatest(F.lit(1), F.ceil(F.col("lang_rows") / bucket_rows)).cast("int")
        block = F.pmod(F.xxhash64("source"), blocks).cast("int").alias("block")
        words = self.shares().select("lang", "source", "term", "p", blocks.alias("blocks"), block, F.pmod(F.xxhash64("term"), buckets).cast("int").alias("bucket"))
        marks = self.groups.where("terms > 0").select(
            "lang", "source", F.lit(None).cast("string").alias("term"), F.col("rest").alias("p"), blocks.alias("blocks"), block, F.explode(F.sequence(F.lit(0), buckets - 1)).alias("bucket")
        )
        # a row goes to every pair of blocks that its own block is part of, the smaller number first
        dealt = words.union(marks).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        dealt = dealt.select("lang", "source", "term", "p", "block", "bucket", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"))
        sums = dealt.groupBy("lang", "bucket", "first", "second").applyInPandas(_block_sums, "lang string, source string, item string, value long, seen long")
        sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("sum"), F.sum("seen").alias("seen"))

        left = self.groups.select("lang", "source", "rest", "terms", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
        right = self.groups.select("lang", F.col("source").alias("item"), F.col("rest").alias("item_rest"), block)
        both = left.join(right, ["lang", "block"]).where(F.col("source") != F.col("item"))
        unseen = (F.col("terms") - F.coalesce("seen", F.lit(0))) * F.coalesce(_difference(F.col("rest"), F.col("item_rest")), F.lit(0))
        value = F.coalesce("sum", F.lit(0)) + unseen
        return _ranked(both.join(sums, ["lang", "source", "item"], "left").select("lang", "source", "item", value.alias("value")))


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


#: Differences held at once.
_CELLS = 1 << 20


def _block_sums(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """For two blocks of sources and one bucket of words: sums of differences, in both directions, and the words seen."""
    lang, _, first, second = key
    marks, words = rows[rows["term"].isna()], rows[rows["term"].notna()]
    terms, at = np.unique(words["term"].to_numpy(dtype=object), return_inverse=True) if len(words) else (np.empty(0, dtype=object), np.empty(0, dtype=np.int64))
    names, tables = [], []
    for block in (first, second):
        own, have = marks[marks["block"] == block], (words["block"] == block).to_numpy()
        index = pd.Index(own["source"])
        table = np.repeat(own["p"].to_numpy(dtype=np.int64)[None, :], len(terms), axis=0)
        table[at[have], index.get_indexer(words["source"][have])] = words["p"][have]
        names.append(index)
        tables.append(table)
    left, right = tables
    there, back = np.zeros((len(names[0]), len(names[1])), dtype=np.int64), np.zeros((len(names[0]), len(names[1])), dtype=np.int64)
    step = max(1, _CELLS // max(1, there.size))
    for i in range(0, len(terms), step):
        p, q = left[i : i + step, :, None], right[i : i + step, None, :]
        square = (p - q) ** 2
        there += (square // q).sum(axis=0)
        if first != second:
            back += (square // p).sum(axis=0)
    a, b = (x.ravel() for x in np.meshgrid(names[0], names[1], indexing="ij"))
    found = pd.DataFrame({"lang": lang, "source": a, "item": b, "value": there.ravel(), "seen": len(terms)})
    if first != second:
        found = pd.concat([found, pd.DataFrame({"lang": lang, "source": b, "item": a, "value": back.ravel(), "seen": len(terms)})])
    return found[found["source"] != found["item"]]


def audit(documents: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` and ``term`` rows of every (language, source)."""
    tables = Audit(documents)
    parts = [(name, rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")) for name, rows in (("pair", tables.pairs()), ("term", tables.top_terms()))]
    return parts[0][1].unionByName(parts[1][1])
