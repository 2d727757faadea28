"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from logloom.sources.scratch import delete_at_exit, scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Has Spark delete the shuffle files of a write when the write ends, not when the driver happens to collect its garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def staged(df: DataFrame, tasks: int | None = None, codec: str = "snappy", batch_rows: int | None = None) -> DataFrame:
    """``df`` written once as Parquet and read again; by ``tasks`` tasks, where many would write little each.

    It cuts the lineage: a lost executor costs a task that rereads the file, not the work that made it.
    The folder comes from ``spark.checkpoint.dir``; what is written there goes when the application ends, since a
    result that reads it may be asked for until then. The shuffle files it was made from go as soon as it is written.
    Python gets at most ``batch_rows`` rows at a time, where given.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    delete_at_exit(spark, path)
    with _settings(spark, {_DROP_SHUFFLES: "true"} | ({_BATCH_ROWS: str(batch_rows)} if batch_rows else {})):
        (df.coalesce(tasks) if tasks else df).write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def blocks_for(rows: int, rows_per_block: int) -> int:
    """Blocks needed so that a broadcast holds about ``rows_per_block`` rows, whatever the table's size."""
    return max(1, math.ceil(rows / rows_per_block))
