"""Where the output tables go."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from .scratch import dated_folders, delete_path

APPEND = "append"
APPEND_NEW = "append_new"
OVERWRITE_PARTITIONS = "overwrite_partitions"
MODES = (APPEND, APPEND_NEW, OVERWRITE_PARTITIONS)


def write_table(rows: DataFrame, output: str, name: str, mode: str = APPEND) -> str:
    """Writes one table as Snappy Parquet, partitioned by date, and returns its path.

    ``append`` adds to what is there, so running a date twice doubles its rows;
    ``overwrite_partitions`` replaces exactly the dates present in ``rows``; see ``drop_stale_dates`` for others.
    """
    path = f"{output}/{name.lower()}"
    writer = rows.write.partitionBy("date").option("compression", "snappy")
    if mode == OVERWRITE_PARTITIONS:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == APPEND:
        writer = writer.mode("append")
    else:
        raise ValueError(f"unknown write mode {mode!r}")
    writer.parquet(path)
    return path


def drop_stale_dates(spark: SparkSession, output: str, name: str, start: date, end: date, written: set[date]) -> None:
    """Removes the partitions of a date range that hold nothing of this run.

    To be called after the run's own partitions are in place, so that no reader finds a date gone too early.
    """
    for day, folder in dated_folders(spark, f"{output}/{name.lower()}", start, end).items():
        if day not in written:
            delete_path(spark, folder)


def append_jdbc(rows: DataFrame, name: str, options: dict[str, str]) -> None:
    """Appends one table to a database through Spark's JDBC writer.

    ``options`` are the writer's own: ``url``, ``driver``, ``user``, ``batchsize``, ``numPartitions``
    (which bounds the number of concurrent connections).
    """
    rows.write.format("jdbc").options(**options).option("dbtable", name.lower()).mode("append").save()
