"""Near-duplicate detection: MinHash bands for candidates, odd sketches to screen them, full sets to confirm.

Words are split at ASCII white space after lower-casing A-Z. A document's set holds its distinct five-word
shingles; with fewer words the whole sequence is its only element. A document without words (null, empty) has an
empty set and is linked with nothing. Two documents are linked when their Jaccard similarity is 0.75 or more;
groups are the connected components.

1. One pass over the texts gives each document a digest of its set, 32 bands of 4 MinHash values, and an odd
   sketch: each of 256 MinHash samples toggles one of 1,024 bits. Equal sets become one node.
2. Nodes that share a band form a bucket. Each node is compared with one centre first, the smallest node of its
   buckets, on full sets. Confirmed links make groups.
3. Buckets that still hold several groups are searched in blocks, by the population count of the XOR of sketches,
   for nodes close to a node of another group. Only the nodes are passed on, never the pairs. Estimates below
   ``SKETCH_FLOOR`` are dropped; a pair at 0.75 falls below it about once in ten million times.
4. Groups with close nodes form clusters. Their nodes' full sets, as 64-bit hashes, are compared in blocks of
   similar set sizes, and the links found are passed on. No bucket or cluster is capped; the work within one is
   spread over its blocks.

A pair at exactly 0.75 shares no band with probability 5e-6; above that, less. Repeated rows, equal ids included,
are rows of the same group. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.bit_filter import broadcast_filter
from logloom.llm.components import connected_components
from logloom.llm.storage import blocks_for, staged
from logloom.llm.words import NOT_WHITE, Chunk, chunks, gram_hashes, mixed
from logloom.llm.workers import lean

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 75
BANDS, ROWS = 32, 4
SAMPLES = 256
SKETCH_BITS = 1024
SKETCH_FLOOR = 0.58
BLOCK = 1024
SET_BLOCK = 256
NODES_PER_TASK = 10_000
#: Rows with their texts that a Python worker and Spark hold at once.
ROWS_AT_ONCE = 2_000
#: Rows with one or two full sets, which are larger than their texts.
SETS_AT_ONCE = 500
#: Bytes of text whose shingles are laid out at once.
BYTES_AT_ONCE = 250_000

_rng = np.random.default_rng(75)
_XORS = _rng.integers(0, 1 << 63, size=SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _rng.integers(0, 1 << 63, size=SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SAMPLE_KEYS = _rng.integers(0, 1 << 63, size=SAMPLES, dtype=np.uint64)


def shingle_sets(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): document d of the chunk has the sorted distinct hashes[bounds[d]:bounds[d + 1]]."""
    at, grams = chunk.grams(SHINGLE_WORDS)
    cuts = np.searchsorted(at, chunk.doc_words)
    sets = []
    for d in range(chunk.n_docs):
        first, last = chunk.doc_words[d], chunk.doc_words[d + 1]
        if last - first >= SHINGLE_WORDS:
            sets.append(np.unique(grams[cuts[d] : cuts[d + 1]]))
        elif last > first:
            sets.append(gram_hashes(chunk.hashes, np.array([first]), int(last - first)))
        else:
            sets.append(np.empty(0, dtype=np.uint64))
    return np.concatenate(sets), np.cumsum([0, *map(len, sets)])


def min_hashes(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of ``SAMPLES`` MinHash values for each set that is not empty."""
    starts = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(starts), SAMPLES), dtype=np.uint64)
    if len(starts):
        values = np.empty_like(hashes)
        for i in range(SAMPLES):
            np.bitwise_xor(hashes, _XORS[i], out=values)
            np.multiply(values, _FACTORS[i], out=values)
            out[:, i] = np.minimum.reduceat(values, starts)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    keys = np.empty((len(samples), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(len(samples), band + 1, dtype=np.uint64)
        for i in range(band * ROWS, (band + 1) * ROWS):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + samples[:, i])
        keys[:, band] = key
    return keys


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Sixteen 64-bit words a row: bit h is set if an odd number of (sample number, value) pairs falls on it."""
    place = mixed(samples ^ _SAMPLE_KEYS) >> np.uint64(64 - 10)
    flags = np.zeros((len(samples), SKETCH_BITS), dtype=np.uint8)
    for i in range(SAMPLES):
        flags[np.arange(len(samples)), place[:, i].astype(np.int64)] ^= 1
    return np.packbits(flags, axis=1).view(np.uint64)


def largest_distance(floor: float = SKETCH_FLOOR) -> int:
    """The most differing bits of two sketches whose estimate J = 1 + n / 4k * ln(1 - 2z / n) reaches ``floor``."""
    return int(SKETCH_BITS / 2 * (1 - np.exp((floor - 1) * 4 * SAMPLES / SKETCH_BITS)))


def _longs(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


_SIGNATURE = "doc_id {id}, row_key long, n_shingles long, node binary, bands array<long>, sketch array<long>"


def signatures(documents: DataFrame) -> DataFrame:
    """Per row: the digest of its shingle set (null for an empty set), band keys and odd sketch."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(2), NOT_WHITE, fold=True, size=BYTES_AT_ONCE):
                hashes, bounds = shingle_sets(chunk)
                samples = min_hashes(hashes, bounds)
                sizes = np.diff(bounds)
                bands, sketches = _longs(band_keys(samples)), _longs(odd_sketches(samples))
                nodes = [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(bounds[:-1], bounds[1:])]
                rows = batch.slice(chunk.first, chunk.n_docs)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), _lists(bands, sizes), _lists(sketches, sizes)],
                    names=["doc_id", "row_key", "n_shingles", "node", "bands", "sketch"],
                )

    return _keyed(documents).mapInArrow(lean(signed), _SIGNATURE.format(id=documents.schema["doc_id"].dataType.simpleString()))


def _keyed(documents: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return documents.select("doc_id", F.xxhash64("doc_id", text).alias("row_key"), text.alias("text"))


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A list for each row of ``sizes``; those of size 0 get an empty one and have no row in ``values``."""
    lengths = np.where(sizes > 0, values.shape[1], 0)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(np.ascontiguousarray(values).ravel(), pa.int64()))


def _sets_of(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles): the full sets of the given (node, doc_id, row_key), hashes as bytes."""
    keep = broadcast_filter(nodes.select("row_key"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # of the task's rows that pass; equal ones count once
        for batch in batches:
            keys = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            passed = np.flatnonzero(keep.value.may_have(keys))
            _, first = np.unique(keys[passed], return_index=True)
            chosen = [i for i in np.sort(passed[first]).tolist() if int(keys[i]) not in seen]
            seen.update(keys[chosen].tolist())
            batch = batch.take(pa.array(chosen, pa.int64()))
            for chunk in chunks(batch.column(2), NOT_WHITE, fold=True, size=BYTES_AT_ONCE):
                hashes, bounds = shingle_sets(chunk)
                rows = batch.slice(chunk.first, chunk.n_docs)
                own = [hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([rows.column(1), pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in own], pa.binary()), pa.array(own, pa.binary())], names=["row_key", "node", "shingles"])

    found = _keyed(documents).mapInArrow(lean(sets), "row_key long, node binary, shingles binary")
    # equal sets of other rows pass the filter only by chance, equal rows of other tasks always do: one row a node is enough
    return found.join(nodes.select("node", "row_key"), ["node", "row_key"]).dropDuplicates(["node", "row_key"]).select("node", "shingles")


def confirmed(documents: DataFrame, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that are linked: sketches first, then the full sets."""
    sketch = nodes.select("node", "sketch")
    near = staged(
        pairs.join(sketch.withColumnsRenamed({"node": "a", "sketch": "sketch_a"}), "a")
        .join(sketch.withColumnsRenamed({"node": "b", "sketch": "sketch_b"}), "b")
        .where(F.aggregate(F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x) <= largest_distance())
        .select("a", "b")
    )
    ends = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
    sets = staged(_sets_of(documents, nodes.join(ends, "node").select("node", "row_key")), batch_rows=ROWS_AT_ONCE)
    joined = near.join(sets.withColumnsRenamed({"node": "b", "shingles": "set_b"}), "b").join(sets.withColumnsRenamed({"node": "a", "shingles": "set_a"}), "a")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                flags.append(bool(_is_link(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))))
            yield batch.filter(pa.array(flags, pa.bool_())).select([0, 1])

    return joined.select("a", "b", "set_a", "set_b").mapInArrow(lean(linked), "a binary, b binary").distinct()


def _is_link(common, size_a, size_b):
    return 100 * common >= SIMILARITY_PERCENT * (size_a + size_b - common)


class _Groups:
    """Union-find over labels."""

    def __init__(self):
        self.up: dict[bytes, bytes] = {}

    def root(self, label: bytes) -> bytes:
        while (parent := self.up.setdefault(label, label)) != label:
            self.up[label] = self.up[parent]
            label = parent
        return label

    def join(self, a: bytes, b: bytes) -> bool:
        """True if they were apart."""
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a
        return a != b


def _cells(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """The rows of equal keys, of batches sorted by their first ``n_keys`` columns."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        keys = np.stack([table.column(c).to_numpy() for c in range(n_keys)], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for first, last in zip([0, *cuts[:-1].tolist()], cuts.tolist()):
            yield table.slice(first, last - first)
        held = table.slice(cuts[-1]) if len(cuts) else table
    if held is not None and held.num_rows:
        yield held


def _close_nodes(members: DataFrame, sketch: DataFrame) -> DataFrame:
    """(node, label, other): nodes with a close sketch in another group of their bucket, and a group reached so.

    members: (bucket, node, label, main), ``main`` the group of the bucket's centre. Those outside the main group
    meet all members, in blocks of ``BLOCK`` by ``BLOCK``.
    """
    odd = F.col("label") != F.col("main")
    sizes = members.groupBy("bucket").agg(F.ceil(F.count_if(odd) / BLOCK).alias("odd_blocks"), F.ceil(F.count("*") / BLOCK).alias("all_blocks"))
    sized = members.join(staged(sizes.where("odd_blocks > 0")), "bucket").join(sketch, "node")
    spread = F.xxhash64("node")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    one = sized.where(odd).select("bucket", F.pmod(spread, "odd_blocks").alias("i"), upto("all_blocks").alias("j"), F.lit(True).alias("is_odd"), "node", "label", "sketch")
    two = sized.select("bucket", upto("odd_blocks").alias("i"), F.pmod(spread, "all_blocks").alias("j"), F.lit(False).alias("is_odd"), "node", "label", "sketch")
    most = largest_distance()

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, found = _Groups(), {}
        for cell in _cells(batches, 3):
            nodes, labels = cell.column("node").to_pylist(), np.array(cell.column("label").to_pylist(), dtype=object)
            is_odd = cell.column("is_odd").to_numpy()
            one, two = np.flatnonzero(is_odd), np.flatnonzero(~is_odd)
            sketches = _matrix(cell.column("sketch"))
            for k in one.tolist():
                distance = np.bitwise_count(sketches[two] ^ sketches[k]).sum(axis=1)
                near = two[(distance <= most) & (labels[two] != labels[k])].tolist()
                for m in near:
                    groups.join(labels[k], labels[m])
                    found[nodes[m]] = labels[m]
                if near:
                    found[nodes[k]] = labels[k]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in (list(found), list(found.values()), [groups.root(x) for x in found.values()])], names=["node", "label", "other"])

    cells = one.union(two).repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return cells.mapInArrow(lean(close), "node binary, label binary, other binary").distinct()


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy().view(np.uint64).reshape(len(column), -1)


def _cluster_links(members: DataFrame) -> DataFrame:
    """Links (a, b) between labels of a cluster, on full sets.

    members: (cluster, node, label, sketch, shingles). Sets are linked only if neither is below three quarters of
    the other, so a set meets those of its own size class and of the two beside it, in blocks of ``SET_BLOCK``.
    """
    size = F.octet_length("shingles") / 8
    classed = staged(members.withColumn("size_class", F.floor(F.log(size) / F.lit(-np.log(SIMILARITY_PERCENT / 100)) + 1e-9)), batch_rows=ROWS_AT_ONCE)
    blocks = staged(classed.groupBy("cluster", "size_class").agg(F.ceil(F.count("*") / SET_BLOCK).alias("blocks")))
    own = blocks.select("cluster", "size_class", F.col("blocks").alias("own_blocks"))
    above = blocks.select("cluster", (F.col("size_class") - 1).alias("size_class"), F.col("blocks").alias("above_blocks"))
    below = blocks.select("cluster", (F.col("size_class") + 1).alias("size_class"), F.col("blocks").alias("below_blocks"))
    counts = staged(own.join(above, ["cluster", "size_class"], "left").join(below, ["cluster", "size_class"], "left").na.fill(0))
    zero = F.lit(0).cast("long")
    numbers = lambda n: F.when(F.col(n) > 0, F.sequence(zero, F.col(n) - 1)).otherwise(F.array().cast("array<long>"))
    block, level = F.pmod(F.xxhash64("node"), "own_blocks"), F.col("size_class")
    cell = lambda low, step, i, j: F.struct(low.alias("low"), F.lit(step).cast("long").alias("step"), i.alias("i"), j.alias("j"))
    cells = F.concat(
        F.transform(numbers("own_blocks"), lambda j: cell(level, 0, F.least(block, j), F.greatest(block, j))),
        F.transform(numbers("above_blocks"), lambda j: cell(level, 1, block, j)),
        F.transform(numbers("below_blocks"), lambda j: cell(level - 1, 1, j, block)),
    )
    placed = classed.join(counts, ["cluster", "size_class"]).select(F.xxhash64("cluster").alias("cluster"), F.explode(cells).alias("cell"), "node", "label", "sketch", "shingles")
    keys = ["cluster", "low", "step", "i", "j"]
    placed = placed.select("cluster", "cell.*", "node", "label", "sketch", "shingles").repartition(*keys).sortWithinPartitions(*keys)
    most = largest_distance()

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches, len(keys)):
            labels = cell.column("label").to_pylist()
            if len(set(labels)) > 1:
                sets = [np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in cell.column("shingles")]
                found = list(_links_in(labels, sets, _matrix(cell.column("sketch")), most))
                yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.binary()) for i in (0, 1)], names=["a", "b"])

    return placed.mapInArrow(lean(linked), "a binary, b binary").distinct()


def _links_in(labels: list[bytes], sets: list[np.ndarray], sketches: np.ndarray, most: int) -> Iterator[tuple[bytes, bytes]]:
    """A spanning set of the links between labels: pairs that links found before connect are passed over."""
    names = {label: i for i, label in enumerate(dict.fromkeys(labels))}
    code = np.array([names[x] for x in labels])
    sizes = np.array([len(x) for x in sets])
    starts = np.cumsum(sizes) - sizes
    distinct, ids = np.unique(np.concatenate(sets), return_inverse=True)
    groups, flags = _Groups(), np.zeros(len(distinct), dtype=bool)
    for k in range(len(sets)):
        near = (np.bitwise_count(sketches[k + 1 :] ^ sketches[k]).sum(axis=1) <= most) & (code[k + 1 :] != code[k])
        if near.any():
            own = ids[starts[k] : starts[k] + sizes[k]]
            flags[own] = True
            common = np.add.reduceat(flags[ids], starts, dtype=np.int64)[k + 1 :]
            flags[own] = False
            for m in (k + 1 + np.flatnonzero(near & _is_link(common, sizes[k], sizes[k + 1 :]))).tolist():
                if groups.join(labels[k], labels[m]):
                    yield min(labels[k], labels[m]), max(labels[k], labels[m])


def near_duplicates(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id of its group), kept, row_key and group.

    row_key is the xxhash64 of id and text; group is null for an empty set.
    """
    signed = staged(signatures(documents), batch_rows=ROWS_AT_ONCE)
    nodes = staged(
        signed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("row_key").alias("row_key"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    )
    tasks = blocks_for(nodes.count(), NODES_PER_TASK)
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    centres = staged(banded.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("last")).where("centre <> last").drop("last"), tasks)
    shared = staged(banded.join(centres, "bucket"), tasks)

    first_pairs = staged(shared.where("node <> centre").groupBy(F.col("node").alias("b")).agg(F.min("centre").alias("a")).select("a", "b"), tasks)
    first_links = staged(confirmed(documents, first_pairs, nodes), batch_rows=SETS_AT_ONCE)
    labels = connected_components(first_links)

    def labelled(rows: DataFrame, node: str, label: str) -> DataFrame:
        renamed = labels.select(F.col("node").alias("labelled_node"), F.col("label").alias("found"))
        return rows.join(renamed, F.col(node) == F.col("labelled_node"), "left").withColumn(label, F.coalesce("found", node)).drop("labelled_node", "found")

    members = labelled(labelled(shared, "node", "label"), "centre", "main").select("bucket", "node", "label", "main")
    close = staged(_close_nodes(staged(members, tasks), nodes.select("node", "sketch")))
    reached = connected_components(staged(close.select(F.col("label").alias("a"), F.col("other").alias("b")).distinct(), tasks)).select(F.col("label").alias("cluster"), F.col("node").alias("label"))
    wanted = staged(close.select("node", "label").distinct().join(reached, "label"), tasks)
    sets = _sets_of(documents, nodes.join(wanted.select("node"), "node").select("node", "row_key"))
    between = staged(_cluster_links(wanted.join(nodes.select("node", "sketch"), "node").join(sets, "node").select("cluster", "node", "label", "sketch", "shingles")), batch_rows=SETS_AT_ONCE)
    joined = connected_components(between).withColumnsRenamed({"node": "old", "label": "new"})
    group = labelled(nodes.select("node", "doc_id"), "node", "label").join(joined, F.col("label") == F.col("old"), "left").select("node", "doc_id", F.coalesce("new", "label").alias("label"))
    group = staged(group, tasks)
    smallest = staged(group.groupBy("label").agg(F.min("doc_id").alias("component_id")), tasks)
    of_node = staged(group.join(smallest, "label").select(F.col("node").alias("group_node"), "label", "component_id"), tasks)
    rows = signed.select("doc_id", "row_key", "n_shingles", "node").join(of_node, F.col("node") == F.col("group_node"), "left")
    rows = rows.withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "row_key", F.col("label").alias("group"))


def without_near_duplicates(documents: DataFrame) -> DataFrame:
    """One row of each group, all columns as they came: the one of the smallest doc_id.

    A document with an empty set is a group of its own; of one id, only those equal in all columns count as one row, and those
    without an id all stay. Other rows of one id and text count as one.
    """
    found = near_duplicates(documents)
    grouped = found.where("group is not null").groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")).alias("first"))
    chosen = grouped.select(F.col("first.row_key").alias("key"))
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    text = F.col("text").cast("string")
    has_words = F.coalesce(text.rlike("[^ \\t-\\r]"), F.lit(False))
    kept = documents.where(has_words).select(row.alias("row"), F.xxhash64("doc_id", text).alias("key")).join(staged(chosen), "key", "left_semi")
    # rows that share a key by chance alone are both chosen, so they are told apart here
    kept = kept.groupBy("key", "row.doc_id", F.md5(F.col("row.text").cast("string"))).agg(F.first("row").alias("row")).select("row.*")
    empty = documents.where(~has_words)
    named = empty.where("doc_id is not null").groupBy("doc_id", F.md5(F.to_json(row)).alias("digest")).agg(F.first(row).alias("row")).select("row.*")
    return kept.unionAll(named).unionAll(empty.where("doc_id is null"))
