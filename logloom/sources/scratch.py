"""Shared scratch space for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str | None:
    """The folder the cluster names for checkpoints, if it names one."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def new_path(parent: str) -> str:
    return f"{parent.rstrip('/')}/logloom-{uuid.uuid4().hex}"


def scratch_path(spark: SparkSession) -> str:
    """A fresh path in the shared folder; a local session without one gets a temporary folder."""
    folder = shared_folder(spark)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="run-")
    return new_path(folder)


def _file_system(spark: SparkSession, path: str):
    """(file system, path), as the cluster's configuration has them."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(target)


def child_names(spark: SparkSession, path: str, files: bool = False) -> list[str]:
    """Names of the folders (or files) right below ``path``, none if it does not exist. One listing call."""
    fs, folder = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isFile() == files) if fs.exists(folder) else []


def first_footer(spark: SparkSession, folder: str) -> str | None:
    """The schema in the footer of a folder's first Parquet file, None if it has none."""
    names = [n for n in child_names(spark, folder, files=True) if not n.startswith(("_", "."))]
    if not names:
        return None
    hadoop = spark._jvm.org.apache.parquet.hadoop
    _, file = _file_system(spark, f"{folder}/{names[0]}")
    reader = hadoop.ParquetFileReader.open(hadoop.util.HadoopInputFile.fromPath(file, spark._jsc.hadoopConfiguration()))
    try:
        return reader.getFooter().getFileMetaData().getSchema().toString()
    finally:
        reader.close()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def modified_seconds(spark: SparkSession, path: str) -> float:
    """When ``path`` itself was last changed, in seconds since 1970."""
    fs, target = _file_system(spark, path)
    return fs.getFileStatus(target).getModificationTime() / 1000


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _file_system(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _file_system(spark, path)
    opened = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Moves a file or folder to a name that is not taken; False, and nothing moved, where it is.

    One call that either happens or does not on file systems with such a rename (HDFS and its like).
    """
    fs, old = _file_system(spark, source)
    _, new = _file_system(spark, target)
    hadoop = spark._jvm.org.apache.hadoop.fs
    no_options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    fs.mkdirs(new.getParent())
    try:
        hadoop.FileContext.getFileContext(old.toUri(), spark._jsc.hadoopConfiguration()).rename(old, new, no_options)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def dated_folders(spark: SparkSession, path: str, start: date, end: date) -> dict[date, str]:
    """The ``date=YYYY-MM-DD`` folders below ``path`` of an inclusive range."""
    found = {}
    for name in child_names(spark, path):
        key, _, value = name.partition("=")
        if key == "date":
            try:
                day = date.fromisoformat(value)
            except ValueError:  # the null partition, or a folder of another kind
                continue
            if start <= day <= end:
                found[day] = f"{path.rstrip('/')}/{name}"
    return found


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Has ``path`` deleted when the application ends: what reads it may come at any time until then."""
    fs, target = _file_system(spark, path)
    fs.deleteOnExit(target)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)
