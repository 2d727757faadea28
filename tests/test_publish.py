"""Published states, appends without doubles, and runs that go on from their staging table."""

import os
import tempfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from logloom.operators import filter_logs, known_spellings, rows_not_in
from logloom.operators.shape import TABLES
from logloom.plans import pipeline, run
from logloom.plans.staging import Stage, run_fingerprint
from logloom.sources import ConcurrentChange, outputs, read_published, read_raw_logs, remove_unpublished, snapshots
from logloom.sources.raw_logs import RAW_SCHEMA, folders_by_schema
from logloom.sources.scratch import read_text, rename_new, write_text
from workload.logs import event_logs

SF = "/root/testdata/sf0.001"
FIRST, LAST = date(2024, 1, 3), date(2024, 1, 6)
NAMES = ["dead_letter", *(t.name for t in TABLES)]


class Killed(Exception):
    pass


def new_folder():
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture(scope="module")
def source(spark):
    path = new_folder() + "/raw"
    event_logs(spark, SF).write.partitionBy("date").parquet(path)
    return path


def state(spark, output, version=None):
    """Every table's rows, as text."""
    found = {name: read_published(spark, output, name, version) for name in NAMES}
    return {name: sorted(map(str, rows.collect())) for name, rows in found.items() if rows is not None}


def fail_at(monkeypatch, layout, name):
    """The table's write raises before it writes."""
    real = layout.write

    def write(self, rows, table):
        if table == name:
            raise Killed(table)
        real(self, rows, table)

    monkeypatch.setattr(layout, "write", write)


def test_a_run_that_dies_between_tables_leaves_the_old_state(spark, source, monkeypatch):
    output = new_folder()
    counts = run(spark, source, output, FIRST, FIRST, layout="snapshots")
    before = state(spark, output)
    assert {n: len(rows) for n, rows in before.items()} == {n: counts[n] for n in NAMES if counts.get(n)}
    with monkeypatch.context() as patch:
        fail_at(patch, outputs.Snapshots, "repay")
        with pytest.raises(Killed):
            run(spark, source, output, FIRST, LAST, mode="overwrite_partitions", layout="snapshots")
    assert len(os.listdir(f"{output}/deposit")) > 1  # files of the dead run are there, and nobody reads them
    assert state(spark, output) == before and snapshots.versions(spark, output) == [1]
    counts = run(spark, source, output, FIRST, LAST, mode="overwrite_partitions", layout="snapshots")
    assert {n: len(rows) for n, rows in state(spark, output).items()} == {n: counts[n] for n in NAMES}
    assert state(spark, output, 1) == before
    one_day = read_published(spark, output, "deposit", start=LAST, end=LAST)
    assert {r["date"] for r in one_day.collect()} == {LAST} and all(f"date={LAST}" in f for f in one_day.inputFiles())


def test_unpublished_folders_are_removed(spark, source, monkeypatch):
    output = new_folder()
    run(spark, source, output, FIRST, FIRST, layout="snapshots")
    run(spark, source, output, FIRST, FIRST, mode="overwrite_partitions", layout="snapshots")
    before = state(spark, output)
    assert remove_unpublished(spark, output, NAMES, keep_versions=2, older_than_hours=0) == []
    assert remove_unpublished(spark, output, NAMES) == []  # too young
    gone = remove_unpublished(spark, output, NAMES, older_than_hours=0)
    assert len(gone) == len(before) and not any(map(os.path.exists, gone))
    assert state(spark, output) == before and snapshots.versions(spark, output) == [2]


def test_two_runs_take_turns_at_the_version(spark, source, monkeypatch):
    """The second has looked up the version before the first published: it builds on the first one's state."""
    output = new_folder()
    run(spark, source, output, FIRST, FIRST, layout="snapshots")
    real, stale = snapshots.latest_version, [0]
    monkeypatch.setattr(snapshots, "latest_version", lambda *a: stale.pop() if stale else real(*a))
    run(spark, source, output, LAST, LAST, layout="snapshots")
    assert snapshots.versions(spark, output) == [1, 2] and not stale
    assert {r["date"] for r in read_published(spark, output, "borrow").collect()} == {FIRST, LAST}
    assert [n for n in os.listdir(f"{output}/_manifests") if not n.endswith(".json") and not n.startswith(".")] == []


def test_days_that_changed_meanwhile_are_refused(spark, source, monkeypatch):
    output = new_folder()
    run(spark, source, output, FIRST, FIRST, layout="snapshots")
    real = outputs.Snapshots.finish

    def late(self, *args):
        monkeypatch.setattr(outputs.Snapshots, "finish", real)
        run(spark, source, output, FIRST, LAST, mode="append_new", layout="snapshots")
        real(self, *args)

    monkeypatch.setattr(outputs.Snapshots, "finish", late)
    with pytest.raises(ConcurrentChange):
        run(spark, source, output, FIRST, LAST, mode="append_new", layout="snapshots")
    assert snapshots.versions(spark, output) == [1, 2]


def test_names_are_taken_once(spark):
    folder = new_folder()
    for name, text in (("a", "one"), ("b", "two é")):
        write_text(spark, f"{folder}/{name}", text)
    assert rename_new(spark, f"{folder}/a", f"{folder}/new/c") and not rename_new(spark, f"{folder}/b", f"{folder}/new/c")
    assert read_text(spark, f"{folder}/new/c") == "one" and read_text(spark, f"{folder}/b") == "two é"


@pytest.mark.parametrize("bits", [7, 24])
def test_rows_not_in(spark, bits):
    """With a bit table that is full, and with one that is nearly empty."""
    existing = spark.range(500).select(F.concat(F.lit("t"), F.col("id") % 100).alias("transaction_hash"), F.col("id").alias("log_index"))
    existing = existing.union(spark.createDataFrame([(None, 1), ("t1", None)], "transaction_hash string, log_index long"))
    new = spark.range(300, 900).select(F.concat(F.lit("t"), F.col("id") % 100).alias("transaction_hash"), F.col("id").cast("int").alias("log_index"), F.lit(1).alias("_fresh_x"))
    new = new.union(new.where("log_index > 890")).union(spark.createDataFrame([(None, 1, 1), ("t1", None, 1)], "transaction_hash string, log_index int, _fresh_x int"))
    got = rows_not_in(new, existing, bits=bits)
    assert got.columns == new.columns
    expected = [(f"t{i % 100}", i) for i in [*range(500, 900), *range(891, 900)]] + [(None, 1), ("t1", None)]
    assert sorted(map(str, ((r[0], r[1]) for r in got.collect()))) == sorted(map(str, expected))
    assert rows_not_in(new, existing.limit(0), bits=bits).count() == new.count()


def test_append_new_adds_nothing_twice(spark, source):
    output = new_folder()
    counts = run(spark, source, output, FIRST, LAST, mode="append_new")
    assert run(spark, source, output, FIRST, LAST, mode="append_new") == counts
    for name in NAMES:
        rows = spark.read.parquet(f"{output}/{name}")
        assert rows.count() == rows.select("transaction_hash", "log_index").distinct().count() == counts[name]


@pytest.mark.parametrize("layout", ["folders", "snapshots"])
def test_restart_goes_on_from_the_staging_table(spark, source, monkeypatch, layout):
    output, staging = new_folder(), new_folder()
    args = dict(mode="append_new", layout=layout, staging=staging, restart=True)
    with monkeypatch.context() as patch:
        fail_at(patch, outputs.LAYOUTS[layout], "repay")
        with pytest.raises(Killed):
            run(spark, source, output, FIRST, LAST, **args)
    (stage,) = os.listdir(staging)
    assert "_done-deposit" in os.listdir(f"{staging}/{stage}") and "_done-repay" not in os.listdir(f"{staging}/{stage}")
    written = []
    with monkeypatch.context() as patch:
        patch.setattr(Stage, "write", lambda *a: pytest.fail("the raw logs were scanned again"))
        real = outputs.LAYOUTS[layout].write
        patch.setattr(outputs.LAYOUTS[layout], "write", lambda self, rows, name: (written.append((name, rows.inputFiles())), real(self, rows, name)))
        counts = run(spark, source, output, FIRST, LAST, **args)
    assert [name for name, _ in written] == ["repay"]
    assert all(f"{staging}/logloom-" in file for _, files in written for file in files)
    assert os.listdir(staging) == []
    rows = {n: (read_published(spark, output, n) if layout == "snapshots" else spark.read.parquet(f"{output}/{n}")).count() for n in NAMES}
    assert rows == {n: counts[n] for n in NAMES}


def test_fingerprint_follows_files_and_settings(spark, source):
    path = new_folder() + "/raw"
    read_raw_logs(spark, source, FIRST, LAST).write.partitionBy("date").parquet(path)
    one = run_fingerprint(spark, path, FIRST, LAST, ("a",))
    assert one == run_fingerprint(spark, path, FIRST, LAST, ("a",)) != run_fingerprint(spark, path, FIRST, LAST, ("b",))
    read_raw_logs(spark, source, LAST, LAST).limit(1).write.partitionBy("date").mode("append").parquet(path)
    assert run_fingerprint(spark, path, FIRST, LAST, ("a",)) != one
    assert len(run_fingerprint(spark, path, date(2030, 1, 1), date(2030, 1, 2), ())) == 32


def test_counts_come_with_the_write(spark, source, monkeypatch):
    monkeypatch.setattr(pipeline, "target_counts", lambda staged: pytest.fail("the staging table was read for its counts"))
    counts = run(spark, source, new_folder(), FIRST, LAST)
    monkeypatch.undo()
    logs = filter_logs(read_raw_logs(spark, source, FIRST, LAST))
    assert counts == {r["target"]: r["count"] for r in pipeline.with_target(logs).groupBy("target").count().collect()}


def test_refused_arguments(spark, source):
    for match, settings in (
        ("mode", {"mode": "merge"}),
        ("layout", {"layout": "tape"}),
        ("append_new", {"restart": True}),
        ("appended", {"sink": "both", "jdbc": {"url": "jdbc:none"}, "mode": "append_new"}),
    ):
        with pytest.raises(ValueError, match=match):
            run(spark, source, new_folder(), FIRST, LAST, **settings)


def test_spellings_reach_the_reader(spark, source):
    logs = read_raw_logs(spark, source, FIRST, date(2024, 1, 30))
    found = known_spellings(logs)
    assert found is not None and any(a != a.lower() for a in found) and known_spellings(logs, most=2) is None
    pushed = filter_logs(logs, spellings=found)
    plan = pushed._jdf.queryExecution().executedPlan().toString()
    assert "In(address, [" in plan and "lower(address" not in plan
    assert sorted(map(str, pushed.collect())) == sorted(map(str, filter_logs(logs).collect()))
    assert filter_logs(logs, spellings=[]).count() == 0
    assert run(spark, source, new_folder(), FIRST, LAST, find_spellings=True) == run(spark, source, new_folder(), FIRST, LAST)


def test_days_of_different_types(spark, source):
    path = new_folder() + "/raw"
    logs = read_raw_logs(spark, source, FIRST, LAST)
    kinds = [
        (logs, 3),
        (logs.withColumn("block_number", F.when(F.col("log_index") % 2 == 0, F.lit("x")).otherwise(F.col("block_number").cast("string"))), 4),
        (logs.drop("transaction_hash").withColumn("extra", F.lit(1)), 5),
        (logs.withColumn("extra", F.lit("e")), 6),
    ]
    for rows, day in kinds:
        rows.where(F.dayofmonth("date") == day).write.partitionBy("date").mode("append").parquet(path)
    os.makedirs(f"{path}/date=2024-01-02")
    assert len(folders_by_schema(spark, [f"{path}/date=2024-01-0{d}" for d in range(2, 7)])) == 4
    got = read_raw_logs(spark, path, date(2024, 1, 2), LAST, schema=None)
    kinds = dict(got.dtypes)
    assert kinds["block_number"] == "bigint" and kinds["extra"] == "string"
    assert kinds["topics"] == "array<string>" and set(RAW_SCHEMA.split()[::2]) <= set(kinds)
    assert got.count() == logs.count()
    nulls = {r["date"].day: r["n"] for r in got.where("block_number IS NULL OR transaction_hash IS NULL").groupBy("date").agg(F.count("*").alias("n")).collect()}
    assert nulls == {4: logs.where("dayofmonth(date) = 4 AND log_index % 2 = 0").count(), 5: logs.where("dayofmonth(date) = 5").count()}
