"""The raw log table."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import dated_folders, first_footer

RAW_SCHEMA = (
    "block_number bigint, block_timestamp timestamp, transaction_hash string, log_index bigint, "
    "address string, topics array<string>, data string, date date"
)


def read_raw_logs(
    spark: SparkSession, path: str, start: date, end: date, schema: str | None = RAW_SCHEMA
) -> DataFrame:
    """Logs of an inclusive date range from a Parquet dataset laid out as ``date=YYYY-MM-DD``.

    The root is listed once and only the range's folders are read, so a day costs its own files however
    many days the dataset has. A range without folders is empty. ``schema=None`` takes the schema from the
    files; where days differ, see ``united``.
    """
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    folders = dated_folders(spark, path, start, end)
    if not folders:  # for the columns; no file of it is read
        logs = reader.parquet(path) if schema is None else spark.createDataFrame([], schema)
        return logs.where(F.lit(False))
    groups = [list(folders.values())] if schema is not None else folders_by_schema(spark, list(folders.values()))
    return united([reader.parquet(*group) for group in groups]).where(F.col("date").between(F.lit(start), F.lit(end)))


def folders_by_schema(spark: SparkSession, folders: list[str]) -> list[list[str]]:
    """The folders in groups of one file schema, going by one footer of each; a folder's files are taken to be alike.

    Footers are small and read side by side, so a day costs one round trip. A folder without files has no say.
    """
    with ThreadPoolExecutor(max_workers=16) as pool:
        schemas = pool.map(partial(first_footer, spark), folders)
    groups: dict[str, list[str]] = {}
    for folder, found in zip(folders, schemas):
        if found is not None:
            groups.setdefault(found, []).append(folder)
    return list(groups.values()) or [folders]


def united(parts: list[DataFrame]) -> DataFrame:
    """The parts' rows under one schema.

    A column that has the same type in all parts keeps it. One that differs takes the type of ``RAW_SCHEMA``, text if
    it is not named there; what does not convert is NULL, and so is a column that a part lacks.
    """
    if len(parts) == 1:
        return parts[0]
    usual = dict(item.split() for item in RAW_SCHEMA.split(", "))
    types: dict[str, set[str]] = {}
    for part in parts:
        for name, kind in part.dtypes:
            types.setdefault(name, set()).add(kind)
    differ = {name: usual.get(name, "string") for name, kinds in types.items() if len(kinds) > 1}
    alike = [p.withColumns({n: F.col(n).try_cast(kind) for n, kind in differ.items() if n in p.columns}) for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), alike)
