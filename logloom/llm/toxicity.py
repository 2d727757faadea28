"""Toxicity: a support vector machine on a gap-weighted subsequence kernel with Nystroem landmarks.

The kernel of two strings counts the three-character subsequences they share, each weighted by ``DECAY`` to the
span it takes up in either, so an insult still matches with letters inserted, doubled or left out. Spans reach
``SPAN`` characters. Strings are units of a sentence: its words, without marks inside them, and runs of single
characters written apart, joined. Values are normalised by the strings' own weights.

Landmarks are the units that most mark toxic training documents, and common ones of clean documents. The Nystroem
map sends a unit to the inverse square root of the landmarks' kernel matrix times its kernel values; a linear
support vector machine (squared hinge) is fitted there on labelled sentences. A sentence is represented by the
unit that most marks toxic documents; a toxic document's sentences without such a unit are not used, for they may
be clean. The machine is fitted again with the clean sentences represented by the units that it took most for toxic, the worst of them as landmarks, too.
The fitted function is linear in the kernel, so it folds into one weight per subsequence, and scoring a unit is a
sum over its subsequences, whatever the number of landmarks. A document's best units give its probability, by a
logistic function fitted on the training documents, which weighs both kinds as often as they are among all labels; a
document's length has no part in it.

The machine is fitted on at most ``MOST_DOCUMENTS`` labelled documents of each kind, in the order of a hash of the
id: a documented bound. Every document is scored on its whole text. Null and empty texts have no units and get the
lowest score. Repeated rows are scored each on their own. Without labels of both kinds all scores are 0. Other
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.storage import staged
from logloom.llm.workers import give_back, lean

SPAN = 7
DECAY = 0.6
TOXIC_LANDMARKS, CLEAN_LANDMARKS = 192, 64
MOST_DOCUMENTS = 4_000
#: Sentences taken of a clean document: those with the strongest marks, and up to so many of the others, at a stride.
MARKED_SENTENCES, OTHER_SENTENCES, OTHER_STRIDE = 6, 4, 8
#: Units that may mark a sentence as toxic, at most; their least log odds, and these over their standard error.
MOST_MARKS = 4_000
LEAST_LOG_ODDS, LEAST_MARK = 1.5, 2.5
RIDGE = 1.0
#: Units remembered by a worker, with their scores.
CACHE_UNITS = 100_000
UNITS_AT_ONCE = 25_000
#: (unit, neighbours) pairs that a task of the marking step holds before it hands them on.
CONTEXTS_AT_ONCE = 50_000
BEST = 4
#: Times that the machine is fitted again on the clean units that it took most for toxic.
HARD_ROUNDS = 2
#: Landmarks added at each of these.
HARD_LANDMARKS = 64
#: Units whose subsequences are laid out at once.
UNITS_MAPPED = 2_000
LONGEST_UNIT = 40

_CLASSES = 64
_OFFSETS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
_WEIGHTS = np.array([DECAY ** (b + 1) for _, b in _OFFSETS])
_MARKS = re.compile(r"[^\w\s]+|_+")
_APART = re.compile(r"(?<!\S)\w(?:[ \t]+\w(?!\S)){2,}")
_SENTENCE_END = re.compile(r"[.!?\n]+\s+|\n+")


def units_of(text: str) -> list[str]:
    """The strings compared: words in lower case without marks, single characters written apart joined.

    A unit of more than ``LONGEST_UNIT`` characters is cut into overlapping ones.
    """
    text = _MARKS.sub("", text.lower())
    text = _APART.sub(lambda m: re.sub(r"\s+", "", m[0]), text)
    units = text.split()
    if any(len(u) > LONGEST_UNIT for u in units):
        step = LONGEST_UNIT - SPAN - 3
        units = [u[i : i + LONGEST_UNIT] for u in units for i in range(0, max(1, len(u) - SPAN - 3), step)]
    return units


def _identity(text: str) -> int:
    """Of a context or sentence, as a long."""
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) - 2**63


def sentences_of(text: str) -> list[list[str]]:
    return [units for part in _SENTENCE_END.split(text) if (units := sorted(set(units_of(part))))]


def _character_class(code: np.ndarray) -> np.ndarray:
    """1-26 letters, 27-36 digits, else a hash; 0 is kept for padding."""
    other = 37 + code % (_CLASSES - 37)
    digits = np.where((code >= 0x30) & (code <= 0x39), code - 0x30 + 27, other)
    return np.where((code >= 0x61) & (code <= 0x7A), code - 0x60, digits)


def _subsequences(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, rows, weights) of all subsequences of the units; a row's weights are normalised to length 1."""
    joined = "\0".join(units) + "\0" * SPAN
    raw = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
    classes = np.where(raw == 0, 0, _character_class(raw))
    row = np.cumsum(raw == 0)
    codes, rows, weights = [], [], []
    n = len(raw) - SPAN
    first = classes[:n]
    for (a, b), w in zip(_OFFSETS, _WEIGHTS):
        second, third = classes[a : a + n], classes[b : b + n]
        at = np.flatnonzero((first > 0) & (second > 0) & (third > 0) & (row[:n] == row[b : b + n]))
        codes.append((first[at] * _CLASSES + second[at]) * _CLASSES + third[at])
        rows.append(row[at])
        weights.append(np.full(len(at), w))
    codes, rows, weights = (np.concatenate(x) for x in (codes, rows, weights))
    norm = np.sqrt(np.bincount(rows, weights * weights, minlength=len(units)))
    return codes, rows, weights / norm[rows]


@dataclass
class LandmarkTable:
    """Normalised subsequence weights of the landmarks, a column each, for the subsequences they have."""

    row_of: np.ndarray  #: by subsequence code; row 0 is zero
    rows: np.ndarray

    def folded(self, combination: np.ndarray) -> np.ndarray:
        """One weight per subsequence for a linear combination of landmarks."""
        return (self.rows @ combination).astype(np.float32)[self.row_of]


def landmark_table(landmarks: list[str]) -> LandmarkTable:
    codes, columns, weights = _subsequences(landmarks)
    own, places = np.unique(codes, return_inverse=True)
    row_of = np.zeros(_CLASSES**3, dtype=np.int32)
    row_of[own] = np.arange(1, len(own) + 1)
    rows = np.zeros((len(own) + 1, len(landmarks)))
    np.add.at(rows, (places + 1, columns), weights)
    return LandmarkTable(row_of, rows)


def features(units: list[str], table: LandmarkTable) -> np.ndarray:
    """Kernel values of the units (rows) with the landmarks (columns)."""
    codes, rows, weights = _subsequences(units)
    out = np.zeros((len(units), table.rows.shape[1]))
    order = np.argsort(rows, kind="stable")
    codes, rows, weights = codes[order], rows[order], weights[order]
    starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]])) if len(rows) else []
    for k in range(0, len(starts), 128):
        part = slice(starts[k], starts[k + 128] if k + 128 < len(starts) else len(rows))
        own = table.rows[table.row_of[codes[part]]] * weights[part, None]
        out[rows[starts[k : k + 128]]] = np.add.reduceat(own, starts[k : k + 128] - starts[k], axis=0)
    return out


@dataclass
class ToxicityModel:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(_CLASSES**3, dtype=np.float32))  #: per subsequence
    bias: float = -1.0
    logistic: np.ndarray | None = None

    def __post_init__(self):
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def margins(self, units: list[str]) -> list[float]:
        """The machine's value for each unit; the most frequent come from memory."""
        new = [u for u in set(units) if u not in self.known]
        found = {}
        for k in range(0, len(new), UNITS_MAPPED):
            part = new[k : k + UNITS_MAPPED]
            codes, rows, weights = _subsequences(part)
            values = np.bincount(rows, self.weights[codes] * weights, minlength=len(part)) + self.bias
            found.update(zip(part, values.tolist()))
        if len(self.known) + len(found) <= CACHE_UNITS:
            self.known.update(found)
            found = self.known
            return [found[u] for u in units]
        known = self.known
        return [known[u] if u in known else found[u] for u in units]

    def evidence(self, unit_lists: list[list[str]]) -> np.ndarray:
        """Of each document: its best distinct units' margins, and how many are above zero, as a row."""
        margins = iter(self.margins([u for units in unit_lists for u in units]))
        rows = np.full((len(unit_lists), BEST + 1), -2.0)
        for row, units in zip(rows, unit_lists):
            values = np.fromiter((next(margins) for _ in units), dtype=float, count=len(units))
            top = np.sort(np.partition(values, -BEST)[-BEST:] if len(values) > BEST else values)[::-1]
            row[: len(top)] = np.clip(top, -2, 2)
            row[BEST] = np.log1p((values > 0).sum())
        return rows

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.logistic is None:
            return np.zeros(len(rows))
        return 1 / (1 + np.exp(-np.clip(np.hstack([rows, np.ones((len(rows), 1))]) @ self.logistic, -30, 30)))


    def scores(self, texts: Iterable[str]) -> np.ndarray:
        """Of each text; units are looked up together for about ``UNITS_AT_ONCE`` of them."""
        scores, units, held = [np.empty(0)], [], 0
        for text in texts:
            units.append(list(set(units_of(text))))
            held += len(units[-1])
            if held > UNITS_AT_ONCE:
                scores.append(self.score(self.evidence(units)))
                units, held = [], 0
        return np.concatenate([*scores, self.score(self.evidence(units))])


def _support_vectors(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights and bias of the linear machine with a squared hinge, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-6
    weight = weight / weight.sum() * 1000
    for _ in range(25):
        inside = y * (x @ w) < 1
        xs, cs = x[inside], weight[inside]
        new = np.linalg.solve(penalty + (xs * cs[:, None]).T @ xs, (xs * (cs * y[inside])[:, None]).sum(axis=0))
        if np.abs(new - w).max() < 1e-8:
            break
        w = new
    return w


def _logistic(x: np.ndarray, y: np.ndarray, toxic_share: float) -> np.ndarray:
    """Weights and constant; the toxic rows weigh as much of all as they are of all labels."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y > 0, toxic_share / max(y.mean(), 1e-9), (1 - toxic_share) / max(1 - y.mean(), 1e-9))
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-1 * np.eye(len(w)), x.T @ (weight * (p - y)) + 1e-1 * w)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def training_sample(documents: DataFrame, labels: DataFrame, most: int = MOST_DOCUMENTS) -> DataFrame:
    """(text, label): at most ``most`` labelled documents of each kind, by a hash of the id.

    The labels are chosen first, so that only chosen documents' texts are joined.
    """
    spread = F.xxhash64(F.lit("toxicity"), "doc_id")
    wanted = labels.where("doc_id is not null").select("doc_id", F.col("label").cast("int").alias("label"))
    chosen = None
    for kind in (0, 1):
        part = wanted.where(F.col("label") == kind).orderBy(spread, "doc_id").limit(most)
        chosen = part if chosen is None else chosen.union(part)
    chosen = F.broadcast(staged(chosen).withColumnRenamed("doc_id", "chosen_id"))  # 2 * most rows
    texts = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(chosen, F.col("doc_id") == F.col("chosen_id")).select("text", "label")


def marking_units(sample: DataFrame) -> tuple[dict[str, float], list[str]]:
    """Units that mark toxic documents, best first, with their marks, and common units of clean documents.

    A unit is counted once for each pair of neighbours it has, so that copies of a text count once. A mark is the
    log odds of toxic against clean documents over its standard error. A task hands on its pairs when it holds
    ``CONTEXTS_AT_ONCE``; those that come again are told apart by the ``distinct``.
    """
    at_once = CONTEXTS_AT_ONCE

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = set()
            for text, label in zip(batch["text"], batch["label"]):
                units = units_of(text)
                for before, unit, after in zip(["", *units], units, [*units[1:], ""]):
                    found.add((unit, _identity(f"{before} {after}"), int(label)))
                if len(found) >= at_once:
                    yield pd.DataFrame(list(found), columns=["unit", "context", "label"])
                    found = set()
            yield pd.DataFrame(list(found), columns=["unit", "context", "label"])

    contexts = sample.mapInPandas(lean(listed), "unit string, context long, label int").distinct()
    counts = staged(contexts.groupBy("unit").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")))
    total = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    n = {0: total["clean"], 1: total["toxic"]}
    if not n[0] or not n[1]:
        return {}, []
    odds = F.log((F.col("toxic") + 0.5) / (n[1] + 1) / ((F.col("clean") + 0.5) / (n[0] + 1)))
    counts = counts.where((F.length("unit") >= 3) & (F.col("toxic") + F.col("clean") >= 2)).withColumn("odds", odds)
    counts = staged(counts.withColumn("mark", F.col("odds") / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))))
    toxic = counts.where((F.col("toxic") >= 3) & (F.col("odds") > LEAST_LOG_ODDS) & (F.col("mark") > LEAST_MARK)).orderBy(F.desc("mark"), "unit").limit(MOST_MARKS).collect()
    clean = counts.where("clean >= 2").orderBy("mark", "unit").limit(CLEAN_LANDMARKS).collect()
    return {r["unit"]: r["mark"] for r in toxic}, [r["unit"] for r in clean]


Rater = Callable[[list[str]], list[float]]


@dataclass
class Marks:
    """Rates units by their marks; those without one stand below all others."""

    marks: dict[str, float]

    def __call__(self, units: list[str]) -> list[float]:
        return [self.marks.get(u, -1.0) for u in units]


def rated_sentences(sample: DataFrame, rate: Rater) -> dict[tuple[str, int], float]:
    """(unit, label) with counts: the best rated unit represents a sentence, over the sample's distinct sentences.

    Of a clean document, the ``MARKED_SENTENCES`` best rated count, and of the others every ``OTHER_STRIDE``-th, up to
    ``OTHER_SENTENCES``. Of a toxic document, those rated above zero.
    """
    shared = sample.sparkSession.sparkContext.broadcast(rate)

    def chosen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = set()
            for text, label in zip(batch["text"], batch["label"]):
                sentences = sentences_of(text)
                ratings = iter(shared.value([u for units in sentences for u in units]))
                best = sorted(((*max((next(ratings), u) for u in units), _identity(" ".join(units))) for units in sentences), reverse=True)
                for rating, unit, sentence in best if label else best[:MARKED_SENTENCES] + best[MARKED_SENTENCES::OTHER_STRIDE][:OTHER_SENTENCES]:
                    if rating > 0 or not label:
                        found.add((unit, int(label), sentence))
            yield pd.DataFrame(list(found), columns=["unit", "label", "sentence"])

    rows = sample.mapInPandas(lean(chosen), "unit string, label int, sentence long").distinct().groupBy("unit", "label").agg(F.count("*").cast("double").alias("n")).collect()
    return {(r["unit"], r["label"]): r["n"] for r in rows}


def labelled_sentences(sample: DataFrame, marks: dict[str, float]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(units, labels, counts) of ``rated_sentences`` by marks; labels are 1 and -1."""
    found = rated_sentences(sample, Marks(marks))
    return [unit for unit, _ in found], np.array([1.0 if label else -1.0 for _, label in found]), np.array(list(found.values()))


def _machine(landmarks: list[str], examples: dict[tuple[str, int], float]) -> ToxicityModel:
    """The machine fitted on (unit, label) with their numbers; both kinds weigh the same."""
    table = landmark_table(landmarks)
    kernel = features(landmarks, table)
    values, vectors = np.linalg.eigh((kernel + kernel.T) / 2)
    keep = values > 1e-3 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    units = [unit for unit, _ in examples]
    y = np.array([1.0 if label else -1.0 for _, label in examples])
    weight = np.array(list(examples.values()))
    weight = weight / np.where(y > 0, weight[y > 0].sum(), weight[y < 0].sum())
    mapped = [(features(units[k : k + UNITS_MAPPED], table) @ root).astype(np.float32) for k in range(0, len(units), UNITS_MAPPED)]
    w = _support_vectors(np.vstack(mapped), y, weight)
    return ToxicityModel(table.folded(root @ w[:-1]), float(w[-1]))


def fit(documents: DataFrame, labels: DataFrame) -> ToxicityModel:
    sample = staged(training_sample(documents, labels))
    marks, clean = marking_units(sample)
    model = ToxicityModel()
    if not marks:
        return model
    landmarks = list(dict.fromkeys([*marks][:TOXIC_LANDMARKS] + clean))
    examples = Counter(rated_sentences(sample, Marks(marks)))
    model = _machine(landmarks, examples)
    clean_sample = sample.where("label = 0")
    for _ in range(HARD_ROUNDS):
        hard = rated_sentences(clean_sample, model.margins)
        examples.update(hard)
        units = [unit for unit, _ in hard]
        worst = sorted(zip(model.margins(units), units), reverse=True)[:HARD_LANDMARKS]
        landmarks = list(dict.fromkeys([*landmarks, *(unit for _, unit in worst)]))
        model = _machine(landmarks, examples)
    toxic_share = labels.where("doc_id is not null").agg(F.avg(F.col("label").cast("int"))).first()[0]
    model.logistic = _fit_logistic(sample, model, float(toxic_share))
    return model


def _fit_logistic(sample: DataFrame, model: ToxicityModel, toxic_share: float) -> np.ndarray:
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            evidence = shared.value.evidence([list(set(units_of(t))) for t in batch["text"]])
            yield pd.DataFrame({"x": list(evidence), "label": batch["label"]})

    found = sample.mapInPandas(lean(rows), "x array<double>, label int").collect()
    return _logistic(np.array([r["x"] for r in found]), np.array([float(r["label"]) for r in found]), toxic_share)


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) of every document; labels: (doc_id, label) to learn from."""
    model = documents.sparkSession.sparkContext.broadcast(fit(documents, labels))
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.value.scores(text.as_py() or "" for text in batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(lean(scored), f"doc_id {id_type}, score double")


def without_toxic(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents, all columns as they came, with a score below the threshold."""
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    model = documents.sparkSession.sparkContext.broadcast(fit(documents, labels))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        scores = pd.Series(model.value.scores(text or "" for text in texts))
        give_back()
        return scores

    rows = documents.select(row, F.col("text").cast("string").alias("text"))
    return rows.where(score("text") < threshold).select("row.*")
