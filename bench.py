"""Times the engine on logs encoded from ``lineitem`` and prints one JSON line.

The raw logs are encoded once, untimed, into a date-partitioned dataset in a fresh folder. Each query
runs three times into the noop sink and reports the least: the first warms up, and a single sample varies by half on a
shared machine. Under ``baseline`` a row-at-a-time Python UDF decodes the same logs the way a job without native
expressions would: one table, and the whole job of cached decoding, counts and six writes.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from logloom.operators import (  # noqa: E402
    dead_letter_rows,
    decode_logs,
    decode_status,
    decoded_logs,
    event_counts,
    filter_logs,
    shape,
    table_rows,
    with_target,
)
from logloom.operators.shape import DEPOSIT, TABLES  # noqa: E402
from logloom.plans import run  # noqa: E402
from logloom.plans.pipeline import SESSION  # noqa: E402
from logloom.sources import read_raw_logs  # noqa: E402
from workload.logs import lineitem_logs  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
FIRST, LAST = date(2024, 1, 1), date(2024, 1, 30)


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SESSION.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def noop(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


RUNS = 3


def least_of_runs(action) -> float:
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - start)
    return round(min(seconds), 3)


def python_udf_decoded(logs: DataFrame) -> DataFrame:
    """Text map per log by a Python UDF; NULL where a log does not decode."""
    from tests import brute

    @F.udf("map<string,string>")
    def decode(address, topics, data):
        return brute.decode(address, topics, data)[0]

    return logs.withColumn("decoded", decode("address", "topics", "data"))


def python_udf_shape(logs: DataFrame) -> DataFrame:
    """Deposits by a Python UDF: text map per log, then casts."""
    return shape(python_udf_decoded(logs).where(F.col("decoded").isNotNull()), DEPOSIT)


def python_udf_job(logs: DataFrame, output: str) -> None:
    """The whole job by a Python UDF: decoded logs cached, counts, a write for each table and for the dead letters."""
    decoded = python_udf_decoded(logs).cache()
    try:
        good, dead = decoded.where(F.col("decoded").isNotNull()), decoded.where(F.col("decoded").isNull())
        frames = {t.name: shape(good, t) for t in TABLES} | {"dead_letter": dead.drop("decoded")}
        good.count()
        for name, rows in frames.items():
            if rows.count():
                rows.write.partitionBy("date").parquet(f"{output}/{name}")
    finally:
        decoded.unpersist(blocking=True)


def main() -> None:
    spark = session()
    work = tempfile.mkdtemp(prefix="run-")
    source = f"{work}/raw"
    day = F.date_add(F.lit(FIRST), F.col("log_index").cast("int") % 30)
    logs = lineitem_logs(spark, SF_DIR).withColumn("date", day)
    logs.repartition(16, "date").write.partitionBy("date").parquet(source)

    raw = read_raw_logs(spark, source, FIRST, LAST)
    known = filter_logs(raw)
    decoded = decode_logs(known)
    targeted = with_target(known)
    frames = {
        "scan": raw,
        "scan_one_week": read_raw_logs(spark, source, FIRST, date(2024, 1, 7)),
        "filter": known,
        "route_and_check": targeted,
        "decode_map": decoded,
        "decode_status": decode_status(decoded),
        "event_counts": event_counts(decoded),
        "map_deposits": shape(decoded_logs(decoded), DEPOSIT),
        "dead_letter": dead_letter_rows(targeted),
    } | {f"typed_{t.name}": table_rows(targeted, t) for t in TABLES}
    timings = {name: least_of_runs(lambda frame=frame: noop(frame)) for name, frame in frames.items()}
    outputs = iter(range(100))
    timings["pipeline_run"] = least_of_runs(lambda: run(spark, source, f"{work}/out{next(outputs)}", FIRST, LAST))
    baseline = {
        "python_udf_deposits": least_of_runs(lambda: noop(python_udf_shape(known))),
        "python_udf_job": least_of_runs(lambda: python_udf_job(known, f"{work}/udf{next(outputs)}")),
    }
    print(
        json.dumps(
            {
                "metric": "total seconds, least of three runs of each query",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "baseline": baseline,
                "rows": raw.count(),
                "sf": SF_DIR,
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
