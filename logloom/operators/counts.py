"""Row counts per output table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shape import DEAD_LETTER, TABLES, UNSHAPED, EventTable, event_label


def event_counts(decoded: DataFrame, tables: tuple[EventTable, ...] = TABLES) -> DataFrame:
    """(table, n) over ``decode_logs`` output: each event table, ``unshaped`` and ``dead_letter``, in one pass."""
    result = F.col("decode_result")
    table = F.when(~result["success"], F.lit(DEAD_LETTER))
    label = event_label(decoded, result["data"])
    for one in tables:
        table = table.when(label.isin(*one.labels), F.lit(one.name))
    return decoded.groupBy(table.otherwise(F.lit(UNSHAPED)).alias("table")).agg(F.count("*").alias("n"))


def decode_status(decoded: DataFrame) -> DataFrame:
    """(success, error, n): how many logs decoded, and why the others did not."""
    return decoded.groupBy(
        F.col("decode_result.success").alias("success"), F.col("decode_result.error").alias("error")
    ).agg(F.count("*").alias("n"))
