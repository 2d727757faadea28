"""Five operators in a row: toxicity, line dedup, near-duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes to the shared folder and reads
again as the next stage's input. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logloom.llm import decontamination, line_dedup, near_dup, packing, queries, toxicity
from logloom.llm.storage import read_table, staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the labelled documents that are not held out."""
    return toxicity.without_toxic(docs, queries.training_labels(spark, sf_dir, "toxic"))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on more than a tenth of a source's documents go; every document stays."""
    return line_dedup.without_boilerplate(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dup.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go, by the rule of ``decontamination.is_contaminated``."""
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in sequences of 1,024 tokens: a row per piece, with its token ids."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_tokens),
]

#: A learned model and token ids are outside SQL; the tests hold ``run`` against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
