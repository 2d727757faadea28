import os
import subprocess
import sys
import tempfile

from logloom.sources.scratch import delete_at_exit, write_text


def test_scratch_tables_go_with_the_application():
    """In an application of its own, which has to end for it."""
    folder = tempfile.mkdtemp(prefix="run-")
    code = f"""
from pyspark.sql import SparkSession
from logloom.sources.scratch import delete_at_exit
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
spark.range(3).write.parquet({folder + "/gone"!r})
spark.range(3).write.parquet({folder + "/stays"!r})
delete_at_exit(spark, {folder + "/gone"!r})
print(spark.read.parquet({folder + "/gone"!r}).count())
spark.stop()
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300)
    assert done.stdout.split() == ["3"], done.stderr[-2000:]
    assert os.listdir(folder) == ["stays"]


def test_deletion_waits(spark):
    folder = tempfile.mkdtemp(prefix="run-")
    write_text(spark, f"{folder}/a", "x")
    delete_at_exit(spark, f"{folder}/a")
    assert os.path.exists(f"{folder}/a")
