"""Quality classification: random Fourier features, ridge scores from summed normal equations, isotonic calibration.

Each document becomes a short vector of statistics of its whole text. Cosines of fixed random projections of the
standardised vector approximate a Gaussian kernel. Every partition sums its own normal equations, these are summed
again per matrix row, and only the final matrix, whose size the number of features fixes, is solved on the driver.
Two folds give each labelled row a score by a model that has not seen it; the shares of good rows in score bins,
made monotonic by pooling adjacent violators, turn scores into probabilities. The final model uses both folds.

All labelled rows passed in are used, and the moments for standardising come from all documents. Null and empty
texts have the statistics of no words and get a score as any other. Repeated documents and labels count each.
Without labels, or with labels of one kind alone, the score is 0.5 or that kind's share. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.storage import staged
from logloom.llm.words import NOT_WHITE, chunks

FEATURES = 256
WIDTH = 2.0
RIDGE = 1.0
BINS = 256

_KIND = np.zeros(256, dtype=np.uint8)  # 1 letter or byte of one, 2 digit, 3 sentence mark, 4 other mark, 5 white space
_KIND[0x21:0x7F] = 4
_KIND[[ord(c) for c in ".,;:?'\"()-"]] = 3
_KIND[0x30:0x3A] = 2
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _KIND[0x80:] = 1
_KIND[[0x20, *range(0x09, 0x0E)]] = 5

STATISTICS = [
    "log_words", "log_bytes", "word_bytes", "word_bytes_sd", "letters", "digits", "sentence_marks", "other_marks", "mark_runs", "upper_case", "bare_marks", "adjacent_repeats",
    "distinct_words", "distinct_pairs", "words_a_line", "repeated_eights", "short_words", "long_words",
]


def text_statistics(column: pa.Array) -> np.ndarray:
    """A row of ``STATISTICS`` for each text."""
    rows = []
    for chunk in chunks(column, NOT_WHITE, fold=True):
        kinds, lengths = _KIND[chunk.data], chunk.ends - chunk.starts
        runs = np.zeros(len(chunk.data), dtype=bool)
        runs[1:] = (chunk.data[1:] == chunk.data[:-1]) & (kinds[1:] >= 3) & (kinds[1:] < 5)
        upper = (chunk.data >= 0x41) & (chunk.data < 0x5B)
        marks = np.concatenate([[0], np.cumsum((kinds == 3) | (kinds == 4))])
        bare = (marks[chunk.ends] - marks[chunk.starts]) == lengths
        for d in range(chunk.n_docs):
            a, b = chunk.doc_bytes[d], chunk.doc_bytes[d + 1]
            i, j = chunk.doc_words[d], chunk.doc_words[d + 1]
            n, size = max(1, j - i), max(1, b - a)
            words, own = chunk.hashes[i:j], lengths[i:j]
            count = np.bincount(kinds[a:b], minlength=6)
            pairs = words[:-1] * np.uint64(31) + words[1:]
            eights = _windows_of(words, 8)
            rows.append([
                np.log1p(j - i), np.log1p(b - a), own.mean() if j > i else 0, own.std() if j > i else 0, count[1] / size, count[2] / size, count[3] / n, count[4] / n, runs[a:b].sum() / n,
                upper[a:b].sum() / n, bare[i:j].sum() / n, (words[1:] == words[:-1]).sum() / n, len(np.unique(words)) / n, len(np.unique(pairs)) / max(1, len(pairs)),
                np.log1p(n / (1 + (chunk.data[a:b] == 0x0A).sum())), 1 - len(np.unique(eights)) / max(1, len(eights)) if len(eights) else 0, (own <= 3).sum() / n, (own >= 15).sum() / n,
            ])
    return np.array(rows, dtype=np.float64).reshape(-1, len(STATISTICS))


def _windows_of(words: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(max(0, len(words) - n + 1), dtype=np.uint64)
    for k in range(n):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(total)]
    return total


def statistics(documents: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of each row's text."""
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = text_statistics(batch.column(1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(STATISTICS), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "x"])

    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(measured, f"doc_id {id_type}, x array<double>")


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None = None
    knots: tuple[np.ndarray, np.ndarray] = (np.array([0.0]), np.array([0.5]))

    def features(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features of the statistics, and a constant."""
        rng = np.random.default_rng(5)
        directions = rng.normal(size=(len(STATISTICS), FEATURES)) / WIDTH / np.sqrt(len(STATISTICS) / 4)
        phases = rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ directions + phases), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        weights = self.weights if weights is None else weights
        return self.features(x) @ weights if weights is not None else np.zeros(len(x))

    def score(self, x: np.ndarray) -> np.ndarray:
        """The calibrated probability, with a hundredth of the raw order kept inside its steps."""
        raw = self.raw(x)
        return np.clip(0.99 * np.interp(raw, *self.knots) + 0.01 * np.clip(raw, 0, 1), 0, 1)


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.stack(rows.to_list()) if len(rows) else np.empty((0, len(STATISTICS)))


def _normal_equations(labelled: DataFrame, model: QualityModel) -> dict[int, np.ndarray]:
    """Of each fold: the sum of outer products of (features, label), gathered row by row."""

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {0: 0.0, 1: 0.0}
        for batch in batches:
            z = np.hstack([model.features(_matrix(batch["x"])), batch[["label"]].to_numpy()])
            for fold in sums:
                part = z[batch["fold"].to_numpy() == fold]
                sums[fold] = sums[fold] + part.T @ part
        for fold, total in sums.items():
            if not np.isscalar(total):
                yield pd.DataFrame({"fold": fold, "i": np.arange(len(total)), "row": [r.tobytes() for r in total]})

    def added(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(r, dtype=np.float64) for r in parts["row"])
        return pd.DataFrame({"fold": [key[0]], "i": [key[1]], "row": [total.tobytes()]})

    schema = "fold int, i int, row binary"
    rows = labelled.mapInPandas(summed, schema).groupBy("fold", "i").applyInPandas(added, schema).collect()
    size = FEATURES + 2
    out = {fold: np.zeros((size, size)) for fold in (0, 1)}
    for r in rows:
        out[r["fold"]][r["i"]] = np.frombuffer(r["row"], dtype=np.float64)
    return out


def _solve(sums: np.ndarray) -> np.ndarray:
    return np.linalg.solve(sums[:-1, :-1] + RIDGE * np.eye(len(sums) - 1), sums[:-1, -1])


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The nearest non-decreasing sequence, by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks[-1]
            blocks[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.empty(0)


def fit(measured: DataFrame, labels: DataFrame) -> QualityModel:
    """measured: (doc_id, x) of all documents; labels: (doc_id, label) of the rows to learn from."""
    moments = [f(F.get("x", F.lit(k))).alias(f"{name}{k}") for k in range(len(STATISTICS)) for name, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = measured.agg(*moments).first()
    mean, scale = (np.array([row[f"{name}{k}"] or 0.0 for k in range(len(STATISTICS))]) for name in "ms")
    model = QualityModel(mean, np.where(scale > 1e-9, scale, 1.0))
    wanted = labels.where("doc_id is not null and label is not null").select(F.col("doc_id").alias("label_id"), F.col("label").cast("double").alias("label"))
    labelled = staged(measured.join(wanted, F.col("doc_id") == F.col("label_id")).select("x", "label", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("fold")))
    sums = _normal_equations(labelled, model)
    both = sums[0] + sums[1]
    if both[-2, -2] == 0:
        return model
    model.weights = _solve(both)
    unseen = [_solve(sums[1]) if sums[1][-2, -2] else model.weights, _solve(sums[0]) if sums[0][-2, -2] else model.weights]

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            z = model.features(_matrix(batch["x"]))
            raw = np.where(batch["fold"] == 0, z @ unseen[0], z @ unseen[1])
            yield pd.DataFrame({"bin": np.clip(np.floor((raw + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int64), "label": batch["label"]})

    bins = labelled.mapInPandas(binned, "bin long, label double").groupBy("bin").agg(F.count("*").alias("n"), F.sum("label").alias("good")).orderBy("bin").collect()
    n, good = np.array([b["n"] for b in bins], dtype=float), np.array([b["good"] for b in bins])
    shares = isotonic((good + both[-2, -1] / both[-2, -2]) / (n + 1), n)
    model.knots = ((np.array([b["bin"] for b in bins]) + 0.5) / BINS * 2 - 0.5, shares)
    return model


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) of every document; labels: (doc_id, label) to learn from."""
    measured = staged(statistics(documents))
    model = measured.sparkSession.sparkContext.broadcast(fit(measured, labels))
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.value.score(x))], names=["doc_id", "score"])

    return measured.mapInArrow(scored, f"doc_id {id_type}, score double")
