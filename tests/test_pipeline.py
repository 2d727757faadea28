import os
import tempfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from logloom.operators import decode_logs, event_counts, filter_logs
from logloom.operators.shape import TABLES
from logloom.plans import pipeline, run
from logloom.sources import read_raw_logs
from workload.logs import event_logs

SF = "/root/testdata/sf0.001"
FIRST, LAST = date(2024, 1, 3), date(2024, 1, 10)


@pytest.fixture(scope="module")
def source(spark):
    path = tempfile.mkdtemp(prefix="run-") + "/raw"
    event_logs(spark, SF).write.partitionBy("date").parquet(path)
    return path


def new_output():
    return tempfile.mkdtemp(prefix="run-") + "/out"


def rows(spark, output, name):
    return spark.read.parquet(f"{output}/{name}").count()


def test_scan_prunes_partitions(spark, source):
    logs = read_raw_logs(spark, source, FIRST, LAST)
    assert [r["date"] for r in logs.select("date").distinct().orderBy("date").collect()] == [
        date(2024, 1, d) for d in range(3, 11)
    ]
    plan = logs._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert read_raw_logs(spark, source, LAST, FIRST).count() == 0
    assert read_raw_logs(spark, source, FIRST, LAST, schema=None).count() == logs.count()


def test_run_writes_every_table(spark, source):
    output = new_output()
    counts = run(spark, source, output, FIRST, LAST)
    logs = filter_logs(read_raw_logs(spark, source, FIRST, LAST))
    assert counts == {r["table"]: r["n"] for r in event_counts(decode_logs(logs)).collect()}
    for table in [t.name for t in TABLES] + ["dead_letter"]:
        assert rows(spark, output, table) == counts[table]
        assert all(name.startswith(("date=", "_", ".")) for name in os.listdir(f"{output}/{table}"))
    assert sorted(n for n in os.listdir(output) if not n.startswith(("_", "."))) == [
        "borrow", "dead_letter", "deposit", "liquidationcall", "repay", "withdraw"
    ]


def test_append_doubles_and_overwrite_replaces(spark, source):
    output = new_output()
    counts = run(spark, source, output, FIRST, LAST)
    run(spark, source, output, FIRST, FIRST, mode="append")
    first_day = spark.read.parquet(f"{output}/borrow").where(F.col("date") == FIRST).count()
    assert rows(spark, output, "borrow") == counts["borrow"] + first_day // 2
    run(spark, source, output, FIRST, FIRST, mode="overwrite_partitions")
    assert rows(spark, output, "borrow") == counts["borrow"]


def test_overwrite_leaves_no_stale_dates(spark, source):
    """Dates and tables whose rows are gone from the source are gone from the output, within the range only."""
    output = new_output()
    run(spark, source, output, FIRST, LAST, mode="overwrite_partitions")
    last_before = spark.read.parquet(f"{output}/borrow").where(F.col("date") == LAST).count()
    path = tempfile.mkdtemp(prefix="run-") + "/raw"
    read_raw_logs(spark, source, FIRST, FIRST).write.partitionBy("date").parquet(path)
    counts = run(spark, path, output, FIRST, date(2024, 1, 9), mode="overwrite_partitions")
    borrow = spark.read.parquet(f"{output}/borrow")
    assert {r["date"] for r in borrow.select("date").distinct().collect()} == {FIRST, LAST}
    assert borrow.count() == counts["borrow"] + last_before


def test_one_day_reads_its_own_files(spark, source):
    day = read_raw_logs(spark, source, FIRST, FIRST)
    assert day.inputFiles() and all(f"date={FIRST}" in name for name in day.inputFiles())
    assert read_raw_logs(spark, source, date(2024, 1, 30), date(2024, 3, 1)).count() == day.sparkSession.read.parquet(source).where("date >= '2024-01-30'").count()


def test_empty_tables_are_skipped(spark, source):
    output = new_output()
    counts = run(spark, source, output, date(2030, 1, 1), date(2030, 1, 2))
    assert counts == {} and not os.path.exists(f"{output}/deposit")


def test_postgres_without_options_writes_dead_letters_only(spark, source):
    output = new_output()
    counts = run(spark, source, output, FIRST, LAST, sink="postgres")
    assert rows(spark, output, "dead_letter") == counts["dead_letter"]
    assert not os.path.exists(f"{output}/deposit")


def test_jdbc_gets_every_table(spark, source, monkeypatch):
    """The database itself is not started here; the writer is replaced."""
    seen = {}
    monkeypatch.setattr(pipeline, "append_jdbc", lambda frame, name, options: seen.update({name: frame.count()}))
    output = new_output()
    counts = run(spark, source, output, FIRST, LAST, sink="both", jdbc={"url": "jdbc:none"})
    assert seen == {t.name: counts[t.name] for t in TABLES}
    assert rows(spark, output, "deposit") == counts["deposit"]


def test_arguments(spark, source):
    with pytest.raises(ValueError, match="after end"):
        run(spark, source, new_output(), LAST, FIRST)
    with pytest.raises(ValueError, match="appended"):
        run(spark, source, new_output(), FIRST, LAST, sink="both", mode="overwrite_partitions", jdbc={"url": "jdbc:none"})
    with pytest.raises(ValueError, match="sink"):
        run(spark, source, new_output(), FIRST, LAST, sink="tape")


def test_staging_is_removed_and_settings_restored(spark, source):
    folder, output = tempfile.mkdtemp(prefix="run-"), new_output()
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    run(spark, source, output, FIRST, FIRST, staging=folder)
    assert os.listdir(folder) == []
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == before


def test_hot_date_is_split(spark):
    """A third of all rows on one date and target does not end in one staging file."""
    logs = event_logs(spark, "/root/testdata/sf0.01").repartition(8).withColumn(
        "date", F.when(F.col("block_number") % 3 == 0, F.lit(date(2024, 1, 1))).otherwise(F.col("date"))
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        path = tempfile.mkdtemp(prefix="run-") + "/stage"
        staged = pipeline.stage_logs(filter_logs(logs), path)
        files = staged.where((F.col("date") == date(2024, 1, 1)) & (F.col("target") == "borrow"))
        assert files.select(F.input_file_name()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
