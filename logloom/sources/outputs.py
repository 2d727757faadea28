"""The two layouts of the Parquet tables, behind the same four steps: what is there, what is new, write, finish.

``folders``: ``<output>/<table>/date=<day>``, readable by anything, each table on its own. ``snapshots``: see
``snapshots.py``; all tables of a run appear together.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.fresh import rows_not_in
from .scratch import dated_folders
from .sinks import APPEND, APPEND_NEW, OVERWRITE_PARTITIONS, drop_stale_dates, write_table
from .snapshots import latest_version, publish, read_published, write_run

FOLDERS = "folders"
SNAPSHOTS = "snapshots"


class Folders:
    def __init__(self, spark: SparkSession, output: str, start: date, end: date, mode: str, run_id: str):
        self.spark, self.output, self.start, self.end, self.mode = spark, output, start, end, mode

    def existing(self, name: str) -> DataFrame | None:
        """The table's rows of the range."""
        path = f"{self.output}/{name.lower()}"
        folders = dated_folders(self.spark, path, self.start, self.end)
        return self.spark.read.option("basePath", path).parquet(*folders.values()) if folders else None

    def fresh(self, rows: DataFrame, name: str) -> DataFrame:
        """What of ``rows`` is to be written: all of them, or with ``append_new`` those that the range's own days do not have."""
        existing = self.existing(name) if self.mode == APPEND_NEW else None
        return rows if existing is None else rows_not_in(rows, existing)

    def write(self, rows: DataFrame, name: str) -> None:
        write_table(self.fresh(rows, name), self.output, name, APPEND if self.mode == APPEND_NEW else self.mode)

    def finish(self, names: list[str], written: dict[str, StructType], dates: dict[str, set[date]]) -> None:
        """``names``: all tables of the run; ``written``: those with rows; ``dates``: the days of each in this run."""
        if self.mode == OVERWRITE_PARTITIONS:
            for name in names:
                drop_stale_dates(self.spark, self.output, name, self.start, self.end, dates.get(name, set()))


class Snapshots(Folders):
    def __init__(self, spark: SparkSession, output: str, start: date, end: date, mode: str, run_id: str):
        super().__init__(spark, output, start, end, mode, run_id)
        self.run_id, self.base = run_id, latest_version(spark, output)

    def existing(self, name: str) -> DataFrame | None:
        return read_published(self.spark, self.output, name.lower(), self.base, self.start, self.end)

    def write(self, rows: DataFrame, name: str) -> None:
        write_run(self.fresh(rows, name), self.output, name.lower(), self.run_id)

    def finish(self, names: list[str], written: dict[str, StructType], dates: dict[str, set[date]]) -> None:
        replace = ([n.lower() for n in names], self.start, self.end) if self.mode == OVERWRITE_PARTITIONS else None
        unchanged = (self.base, self.start, self.end) if self.mode == APPEND_NEW else None
        schemas = {name.lower(): schema for name, schema in written.items()}
        if schemas or replace:
            publish(self.spark, self.output, self.run_id, schemas, replace, unchanged)


LAYOUTS = {FOLDERS: Folders, SNAPSHOTS: Snapshots}
