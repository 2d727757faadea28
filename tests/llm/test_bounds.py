"""Memory and disk that the operators may hold."""

import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import functions as F

from logloom.llm import decontamination, near_dup, source_divergence, storage, toxicity, words
from logloom.llm.bit_filter import broadcast_filter


class ListParam(AccumulatorParam):
    def zero(self, value):
        return []

    def addInPlace(self, a, b):
        return a + b


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


@pytest.mark.parametrize("make", [lambda rows: storage.staged(rows.groupBy("key").count()), lambda rows: broadcast_filter(rows.groupBy("key").count().select("key"))])
def test_shuffle_files_of_what_is_written_are_dropped(spark, make):
    before = shuffle_files(spark)
    held = make(spark.range(5_000).select((F.col("id") * 7 % 1_000).alias("key")))
    assert held and not shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_texts_reach_python_in_small_batches(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    chunks = near_dup.chunks

    def counted(column, *args, **kwargs):
        seen.add(1)
        return chunks(column, *args, **kwargs)

    monkeypatch.setattr(near_dup, "chunks", counted)
    documents = spark.range(5_000).select(F.col("id").alias("doc_id"), F.lit("one two three four five six").alias("text")).coalesce(1)
    assert near_dup.near_duplicates(documents).where("kept").count() == 1
    assert seen.value >= 3
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"


def test_a_shard_takes_little_memory():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3_000)]
    batch = pa.record_batch([["en"] * 400, ["s"] * 400, [" ".join(rng.choices(words, k=6_000)) for _ in range(400)]], names=["lang", "source", "text"])
    tracemalloc.start()
    n = 0
    for held in source_divergence._shards(iter([batch]), source_divergence.SHARD_BYTES):
        n += source_divergence.shard_counts(*[pa.concat_arrays([b.column(i) for b in held]) for i in range(3)])["n"].sum()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 400 * 6_000
    assert peak < 150e6


def test_looking_up_many_units_takes_little_memory():
    rng = random.Random(4)
    units = ["".join(rng.choices("abcdefghij", k=9)) for _ in range(20_000)]
    tracemalloc.start()
    model = toxicity.ToxicityModel()
    margins = model.margins(units)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert margins[7] == toxicity.ToxicityModel().margins(units[7:8])[0]
    assert peak < 50e6


def test_scoring_many_units_takes_little_memory():
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=9)) for _ in range(500)) for _ in range(200)]
    model = toxicity.ToxicityModel()
    tracemalloc.start()
    scores = model.scores(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(scores) == 200
    assert peak < 28e6


def test_shingles_of_much_text_take_little_memory(monkeypatch):
    texts = pa.array([" ".join(f"w{(i * 7919 + j * 31) % 5_003}" for j in range(400)) for i in range(1_000)])
    monkeypatch.setattr(words, "_BYTE_POWERS", words._Powers(words._BYTE_BASE))
    monkeypatch.setattr(words, "_WORD_POWERS", words._Powers(words._WORD_BASE))
    tracemalloc.start()
    n = 0
    for chunk in near_dup.chunks(texts, words.NOT_WHITE, fold=True, size=near_dup.BYTES_AT_ONCE):
        hashes, bounds = near_dup.shingle_sets(chunk)
        n += len(near_dup.min_hashes(hashes, bounds))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 1_000
    assert peak < 25e6


def test_pairs_of_sets_reach_python_in_small_batches(spark, monkeypatch):
    most = spark.sparkContext.accumulator([], ListParam())
    kept = near_dup.lean

    def watched(task):
        def run(batches):
            def seen():
                for batch in batches:
                    if "set_a" in batch.schema.names:
                        most.add([batch.num_rows])
                    yield batch

            yield from task(seen())

        return kept(run)

    monkeypatch.setattr(near_dup, "lean", watched)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:100] + [f"only{i}"] + base[100:])) for i in range(1_500)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    assert near_dup.near_duplicates(documents).where("kept").count() == 1
    assert sum(most.value) >= 1_000
    assert max(most.value) <= 500


def test_decontamination_hands_python_the_text_alone(spark):
    rows = [(i, f"one two three {i}", "x" * 100) for i in range(20)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, other string")
    benchmark = spark.createDataFrame([("a", "one two three 7")], "item_id string, text string")
    left = decontamination.decontaminate(documents, benchmark, 4)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("ArrowEvalPython") == 1
    assert left.columns == documents.columns
    assert {r.doc_id for r in left.collect()} == set(range(20)) - {7}
