"""The staging table of a run, and what lets a later run go on from it."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.scratch import child_names, dated_folders, delete_path, new_path, path_exists, read_text, rename_new, write_text


def run_fingerprint(spark: SparkSession, source: str, start: date, end: date, identity: tuple) -> str:
    """A digest of what a run depends on: ``identity`` and the source files of the range, by path, size and time.

    The files are listed by Spark and not opened; four numbers of them reach the driver.
    """
    folders = dated_folders(spark, source, start, end)
    files: tuple = ()
    if folders:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(folders.values()))
        one = F.xxhash64("path", "length", "modificationTime")
        files = tuple(listed.agg(F.count("*"), F.sum("length"), F.bit_xor(one), F.sum(one.cast("decimal(38,0)"))).first())
    return hashlib.sha256(repr((identity, files)).encode()).hexdigest()[:32]


def stage_path(parent: str, fingerprint: str | None) -> str:
    """A new path, or the one that all runs of the fingerprint share."""
    return f"{parent.rstrip('/')}/logloom-{fingerprint}" if fingerprint else new_path(parent)


class Stage:
    """A folder that appears under its name once the staging table is complete.

    ``run_id`` is kept beside the table, so that a run that goes on keeps its name.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.run_id = read_text(spark, f"{self.path}/_run") if self.is_complete() else uuid.uuid4().hex

    def is_complete(self) -> bool:
        return path_exists(self.spark, self.path)

    def write(self, rows: DataFrame) -> None:
        """Writes the table by target and date. Of two runs that do so at a time, the later one takes the earlier's."""
        draft = new_path(self.path.rpartition("/")[0])
        try:
            rows.write.partitionBy("target", "date").parquet(draft)
            write_text(self.spark, f"{draft}/_run", self.run_id)
            if not rename_new(self.spark, draft, self.path):
                self.run_id = read_text(self.spark, f"{self.path}/_run")
        finally:
            delete_path(self.spark, draft)

    def read(self, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path)

    def dates(self) -> dict[str, set[date]]:
        """The days of each target, from the folders' names."""
        targets = [name.partition("=")[2] for name in child_names(self.spark, self.path) if name.startswith("target=")]
        return {target: set(dated_folders(self.spark, f"{self.path}/target={target}", date.min, date.max)) for target in targets}

    def once(self, name: str, action: Callable[[], object]) -> None:
        """Runs the action, unless a mark tells that an earlier attempt did."""
        mark = f"{self.path}/_done-{name}"
        if not path_exists(self.spark, mark):
            action()
            write_text(self.spark, mark, "")

    def delete(self) -> None:
        delete_path(self.spark, self.path)
