"""The registered queries of the operators: each one over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import (
    decontamination,
    fill_in_middle,
    html_text,
    license_scan,
    line_dedup,
    near_dup,
    packing,
    phrase_dedup,
    quality_classifier,
    quality_rules,
    source_divergence,
    sql,
    token_counts,
    toxicity,
)
from logloom.llm.storage import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _label_split(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out. A null id has no label and is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def _scored(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select("doc_id", _label_split().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def training_labels(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    return read_table(spark, sf_dir, "labels").where(~_label_split()).select("doc_id", F.col(label).alias("label"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = toxicity.classify(read_table(spark, sf_dir, "documents"), training_labels(spark, sf_dir, "toxic"))
    return _scored(scores, 0.5)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_boilerplate(read_table(spark, sf_dir, "documents"))
    return cleaned.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", F.col("clean_text").alias("text"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality_classifier.classify(read_table(spark, sf_dir, "documents"), training_labels(spark, sf_dir, "quality"))
    return _scored(scores, 0.3)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"))


def op7_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = phrase_dedup.remove_recurring(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontamination.find_hits(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
        decontamination.is_contaminated().alias("contaminated"),
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = fill_in_middle.fill_in_middle(read_table(spark, sf_dir, "documents"))
    text = fill_in_middle.restored(F.col("output"), F.col("form"))
    return changed.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256")
    )


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_license_scan": op6_license_scan,
    "op7_phrase_dedup": op7_phrase_dedup,
    "op8_html_text": op8_html_text,
    "op9_packing": op9_packing,
    "op10_decontamination": op10_decontamination,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_token_counts": op12_token_counts,
    "op13_source_divergence": op13_source_divergence,
}
#: ``corpus_pipeline.run`` is registered with these where it is installed, see ``__spark_entry__.py``.
ORACLE_SQL: dict[str, str] = sql.ORACLE_SQL
