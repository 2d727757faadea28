"""The batch job: raw logs of a date range to event tables and dead letters."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date
from functools import partial
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.decode import DATA
from ..operators.filters import filter_logs, known_spellings
from ..operators.shape import DEAD_LETTER, TABLES, UNSHAPED, EventTable
from ..operators.typed import dead_letter_rows, table_rows, with_target
from ..registry import DEFAULT, Registry
from ..sources import FOLDERS, LAYOUTS, RAW_SCHEMA, append_jdbc, read_raw_logs
from ..sources.outputs import Folders
from ..sources.scratch import shared_folder
from ..sources.sinks import APPEND, MODES
from .staging import Stage, run_fingerprint, stage_path

log = logging.getLogger(__name__)

PARQUET_SINKS = ("parquet", "both")
JDBC_SINKS = ("postgres", "both")
STAGED = ("block_number", "block_timestamp", "transaction_hash", "log_index", "date", "address", "topics", "data", DATA, "def_id", "log_error", "target")
# The shaping projections are wide: above this size HotSpot would leave the fused method interpreted,
# so Spark is told to generate one method per expression instead.
SESSION = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def run(
    spark: SparkSession,
    source: str,
    output: str,
    start: date,
    end: date,
    sink: str = "parquet",
    mode: str = "append",
    registry: Registry = DEFAULT,
    tables: tuple[EventTable, ...] = TABLES,
    schema: str | None = RAW_SCHEMA,
    assume_lowercase: bool = False,
    jdbc: dict[str, str] | None = None,
    staging: str | None = None,
    find_spellings: bool = False,
    layout: str = FOLDERS,
    restart: bool = False,
) -> dict[str, int]:
    """Runs the job and returns the row count of every target, ``unshaped`` and ``dead_letter`` included.

    The raw logs are scanned once: the known logs are routed, checked and written to a staging table
    partitioned by target and date. Each output table then reads its own partition only. A lost executor costs
    the tasks it held, never a second scan of the raw logs.

    ``sink`` is ``parquet``, ``postgres`` or ``both``. Dead letters always go to Parquet. Event tables
    go to the database only when ``jdbc`` holds the writer's options; database rows are appended, so there
    the other modes are refused. Tables without rows are not written.

    ``append`` adds all rows, ``append_new`` those whose (transaction_hash, log_index) the range's own days do not have yet
    in the table, so a repeated run adds nothing. ``overwrite_partitions`` replaces the whole range in every table: dates
    without rows in this run are removed once the writes are done. The counts are of rows found, whatever the mode.

    ``find_spellings`` reads the address column first, for how the known contracts are written, so that the scan proper
    can skip row groups; it is worth it where the known logs are few and addresses are in mixed case.

    ``layout`` is ``folders`` or ``snapshots``; the latter makes all tables of the run readable in one step, through
    ``read_published``, and leaves the former state in place if the run ends before that.

    ``staging`` defaults to the session's ``spark.checkpoint.dir``, else to a hidden folder under ``output``; the
    staging table is deleted at the end. With ``restart`` it is kept when the run fails, with a mark for every table
    that is written, and the next run of the same range, source files and definitions goes on from there.
    """
    if start > end:
        raise ValueError(f"start date {start} is after end date {end}")
    if sink not in PARQUET_SINKS + JDBC_SINKS:
        raise ValueError(f"unknown sink {sink!r}")
    if mode not in MODES:
        raise ValueError(f"unknown write mode {mode!r}")
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}")
    if sink in JDBC_SINKS and jdbc and mode != APPEND:
        raise ValueError(f"a database is only appended to; {mode} would double its rows")
    if restart and mode == APPEND and (layout == FOLDERS or (sink in JDBC_SINKS and jdbc)):
        raise ValueError("a table that was appended to just before a run died would be appended to again; use append_new, or snapshots without a database")
    if sink == "postgres" and not jdbc:
        log.warning("no jdbc options: event tables are not written anywhere")

    parent = staging or shared_folder(spark) or f"{output}/_staging"
    with session_conf(spark, SESSION):
        raw = read_raw_logs(spark, source, start, end, schema)
        known = filter_logs(raw, registry, assume_lowercase, known_spellings(raw, registry) if find_spellings else None)
        identity = (source, output, str(start), str(end), sink, mode, layout, repr(registry), repr(tables), schema, assume_lowercase)
        stage = Stage(spark, stage_path(parent, run_fingerprint(spark, source, start, end, identity) if restart else None))
        done = False
        try:
            if stage.is_complete():
                staged = read_stage(stage, known, registry, tables)
                counts = target_counts(staged)
            else:
                staged, counts = stage_and_count(stage, known, registry, tables)
            dates = stage.dates()
            target = LAYOUTS[layout](spark, output, start, end, mode, stage.run_id)
            n_dead = counts.get(DEAD_LETTER, 0)
            log.info("decoded %d logs, %d dead letters", sum(counts.values()) - n_dead, n_dead)
            writes = {DEAD_LETTER: (dead_letter_rows(staged), target.write)} if n_dead else {}
            for table in tables:
                if not counts.get(table.name):
                    log.warning("no rows for %s, nothing written", table.name)
                elif sink in PARQUET_SINKS or jdbc:
                    write = partial(_write_events, target=target, sink=sink, jdbc=jdbc)
                    writes[table.name] = table_rows(staged, table, registry), write
            _run_all(spark, [partial(stage.once, name, partial(write, rows, name)) for name, (rows, write) in writes.items()])
            names = [DEAD_LETTER] + [t.name for t in tables if sink in PARQUET_SINKS]
            target.finish(names, {name: rows.schema for name, (rows, _) in writes.items() if name in names}, dates)
            done = True
            return counts
        finally:
            if done or not restart:
                stage.delete()


def _write_events(rows: DataFrame, name: str, target: Folders, sink: str, jdbc: dict | None) -> None:
    if sink in PARQUET_SINKS:
        target.write(rows, name)
    if sink in JDBC_SINKS and jdbc:
        append_jdbc(rows, name, jdbc)


def _run_all(spark: SparkSession, jobs: list[Callable[[], object]]) -> None:
    """Submits the independent writes together, so that one table's last tasks do not hold up the next.

    All are waited for; the first failure is raised.
    """
    with ThreadPoolExecutor(max_workers=max(len(jobs), 1)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for job in running:
        job.result()


def stage_logs(
    known: DataFrame, path: str, registry: Registry = DEFAULT, tables: tuple[EventTable, ...] = TABLES
) -> DataFrame:
    """The staging table of some known logs under a path of one's own."""
    return stage_and_count(Stage(known.sparkSession, path), known, registry, tables)[0]


def stage_and_count(
    stage: Stage, known: DataFrame, registry: Registry, tables: tuple[EventTable, ...]
) -> tuple[DataFrame, dict[str, int]]:
    """Writes routed and checked logs, one directory per target and date, and reads them back; with the rows of each target.

    The known logs are a thin slice of what is scanned, spread over every scan task. They are gathered
    by target and date before the write; the rebalance splits a hot date and merges small ones to the
    advisory partition size. Without adaptive execution it could not split, so then nothing is gathered. The rows
    are counted on their way to the files.
    """
    targeted = _staged_columns(known, registry, tables)
    if known.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        targeted = targeted.hint("rebalance", F.col("target"), F.col("date"))
    names = [DEAD_LETTER, UNSHAPED, *(t.name for t in tables)]
    seen = Observation()
    observed = targeted.observe(seen, F.count("*").alias("_all"), *[F.count_if(F.col("target") == name).alias(name) for name in names])
    stage.write(observed)
    staged = read_stage(stage, known, registry, tables)
    found = seen.get
    if not found or sum(found[n] for n in names) != found["_all"]:  # an empty plan reports nothing
        return staged, target_counts(staged)
    return staged, {name: found[name] for name in names if found[name]}


def _staged_columns(known: DataFrame, registry: Registry, tables: tuple[EventTable, ...]) -> DataFrame:
    dead = F.col("target") == DEAD_LETTER
    columns = {name: F.col(name) for name in STAGED}
    # dead letters keep the payload as it came, the others as bytes: half the volume
    columns |= {"data": F.when(dead, F.col("data")), DATA: F.when(~dead, F.col(DATA))}
    return with_target(known, registry, tables).select(*[c.alias(name) for name, c in columns.items()])


def read_stage(stage: Stage, known: DataFrame, registry: Registry, tables: tuple[EventTable, ...]) -> DataFrame:
    return stage.read(_staged_columns(known, registry, tables).schema)


def target_counts(staged: DataFrame) -> dict[str, int]:
    """Rows per target, from the folder names and the files' footers."""
    return {row["target"]: row["count"] for row in staged.groupBy("target").count().collect()}


_users: dict[int, tuple[int, dict[str, str | None]]] = {}
_users_lock = Lock()


@contextmanager
def session_conf(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for the time of a run. Of runs that overlap on a session, the first saves and the last restores."""
    key = id(spark._jsparkSession)
    with _users_lock:
        n, before = _users.get(key) or (0, {k: spark.conf.get(k, None) for k in values})
        _users[key] = n + 1, before
        for k, value in values.items():
            spark.conf.set(k, value)
    try:
        yield
    finally:
        with _users_lock:
            n, before = _users.pop(key)
            if n > 1:
                _users[key] = n - 1, before
            else:
                for k, value in before.items():
                    spark.conf.unset(k) if value is None else spark.conf.set(k, value)
