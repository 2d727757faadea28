"""Line removal by site-relative frequency, in DataFrame functions alone.

A page's distinct lines are counted per host: pages that contain the line, over the host's pages. A line is
boilerplate where that ratio is above ``ratio`` and at least ``least_pages`` pages have it, so that a host of a few
pages loses nothing. All its occurrences on that host go; lines without a word are left alone and never counted.

Lines are compared by the MD5 of their trimmed text. Counting shuffles one (host, digest, count) row per task and
line, so a host with a third of all rows costs a few more rows. The boilerplate lines of a host number at most its
lines per page over ``ratio``; the table of them is joined to the documents by a broadcast only while its counted
rows are below ``broadcast_rows``, else by a shuffle join. Either way the result is the same.

Null hosts are one host. A null text has no lines and stays null. Equal rows count as two pages. Empty tables
give no rows. Other columns, also with clashing names, are kept as they came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.storage import staged

RATIO = 0.1
LEAST_PAGES = 10
BROADCAST_ROWS = 100_000

_EDGES = "^[ \\t-\\r]+|[ \\t-\\r]+\\z"


def _digest(line: Column) -> Column:
    """Of a line's trimmed text; empty for a line without a word."""
    trimmed = F.regexp_replace(line, _EDGES, "")
    return F.when(F.length(trimmed) == 0, F.lit("")).otherwise(F.md5(trimmed))


def boilerplate_lines(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, line, pages, host_pages) of the lines above the ratio; ``line`` is the MD5 of the trimmed text.

    pages: (host, text)
    """
    host_pages = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    lines = pages.select("host", F.explode(F.array_distinct(F.transform(F.split("text", "\n"), _digest))).alias("line")).where("line <> ''")
    counted = lines.groupBy("host", "line").agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages)
    totals = host_pages.withColumnRenamed("host", "total_host")
    return counted.join(totals, F.col("host").eqNullSafe(F.col("total_host"))).where(F.col("pages") > ratio * F.col("host_pages")).select("host", "line", "pages", "host_pages")


def drop_boilerplate(
    documents: DataFrame,
    host: str = "source",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(row, n_lines, n_removed, clean_text): the document as it came, as a struct, and its text without the boilerplate."""
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    rows = documents.select(row, F.col(f"`{host}`").cast("string").alias("host"), F.col("text").cast("string").alias("text"))
    lines = staged(boilerplate_lines(rows.select("host", "text"), ratio, least_pages).select("host", "line"))
    by_host = lines.groupBy(F.col("host").alias("line_host")).agg(F.collect_set("line").alias("boilerplate"))
    if lines.count() <= broadcast_rows:
        by_host = F.broadcast(by_host)
    joined = rows.join(by_host, F.col("host").eqNullSafe(F.col("line_host")), "left")
    all_lines = F.split("text", "\n")
    kept = F.when(F.col("boilerplate").isNull(), all_lines).otherwise(F.filter(all_lines, lambda line: ~F.array_contains("boilerplate", _digest(line))))
    return joined.select("row", "text", all_lines.alias("lines"), kept.alias("kept")).select(
        "row",
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_removed"),
        F.array_join("kept", "\n").alias("clean_text"),
    )


def without_boilerplate(documents: DataFrame, **options) -> DataFrame:
    """The documents with ``text`` cleaned, all columns as they came and in their order."""
    cleaned = drop_boilerplate(documents, **options)
    return cleaned.select(*[F.col("clean_text").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in documents.columns])
