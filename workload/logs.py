"""Raw event logs encoded from rows of a given table, one log per row, by integer formulas.

The formulas (FIXTURES.md, section 5 and 6) are simple enough for SQL to repeat, so that a query's
expected rows can be computed from the source table without decoding any hex.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.registry import DEFAULT
from logloom.registry.model import by_def

UNKNOWN_CONTRACT = "0x" + "11" * 20
CDAI = "0x5d3a536e4d6dbd6114cc1ead35777bab948e3643"
POOL_V2 = "0x7d2768de32b0b80b7a3454c06bdac94a69ddc7a9"
MORPHO = "0xbbbbbbbbbb9cc5e90e3b3af64bdaf62c37eeffcb"
MINT = "0x4c209b5fc8ad50758f13e2e1088ba56a560dff690a1c6fef26394f4c03821c4f"
WITHDRAW_V2 = "0x3115d1449a7b732c986cba18244e897a450f61e1bb8d589cd2e69e6c8924f9f7"
BORROW_V2 = "0xc6a898309e823ee50bac64e45ca8adba6690e99e7841c45d754e2a38e9019d9b"
MORPHO_SUPPLY = "0xedf8870433c83823eb071d3df1caa8d008f12f6440918c20d75a3602cda30fe0"

HEADER = ("date", "block_number", "block_timestamp", "transaction_hash", "log_index", "address", "topics", "data")


def _routes() -> list[tuple[str, str, int]]:
    """(contract, topic0, def_id) in key order."""
    ids = {d: i for i, d in enumerate(DEFAULT.definitions)}
    found = {(c, d.topic0): ids[d] for protocol in DEFAULT.protocols for c, defs in protocol for d in defs}
    return sorted((c, t, i) for (c, t), i in found.items())


def _formula(name: str, kind: str) -> str:
    if name == "timestamp":
        return "timestamp"
    if name == "borrow_rate_mode" or kind == "uint8":
        return "mode"
    return {"uint256": "wide"}.get(kind, kind)


def _words(fields_per_def: list, first: int) -> Column:
    """The hex words of a row's definition; word j of row k, with j counted from ``first``."""
    k, formulas = F.col("k"), [[_formula(*field) for field in fields] for fields in fields_per_def]

    def word(formula: Column, index: Column) -> Column:
        j = index + first
        high, low = (k * 7 + j) % 1000003, (k * 2654435761 + j * 97) % 4294967291
        narrow = (
            F.when(formula == "address", k * 31 + j)
            .when(formula == "bytes32", k * 17 + j)
            .when(formula == "timestamp", k + 1577836800)
            .when(formula == "mode", k % 2 + 1)
            .when(formula == "uint16", (k + j) % 65536)
            .otherwise((k + j) % 2)
        )
        wide = F.concat(F.lpad(F.hex(high), 48, "0"), F.lpad(F.hex(low), 16, "0"))
        return F.lower(F.when(formula == "wide", wide).otherwise(F.lpad(F.hex(narrow), 64, "0")))

    return F.transform(by_def(formulas, "array<string>"), word)


def encode_logs(rows: DataFrame, k: Column, ts: Column) -> DataFrame:
    """One raw log per row; ``k`` is a non-negative bigint, ``ts`` a timestamp."""
    routes = _routes()
    index = {(c, t): i for i, (c, t, _) in enumerate(routes)}
    cases = F.expr("CASE WHEN k % 20 = 19 THEN cast(k div 20 % 14 as int) ELSE -1 END")
    route = (
        F.when(F.col("case") == 11, index[POOL_V2, WITHDRAW_V2])
        .when(F.col("case") == 13, index[POOL_V2, BORROW_V2])
        .when(F.col("case") >= 0, index[CDAI, MINT])
        .otherwise(F.expr(f"cast(k % {len(routes)} as int)"))
    )
    base = (
        rows.select(k.cast("bigint").alias("k"), ts.alias("ts"))
        .withColumn("kind", F.col("k") % 20)
        .withColumn("case", cases)
        .withColumn("route", route)
        .withColumn("def_id", by_def([i for _, _, i in routes], "int", "route"))
        .withColumn("contract", by_def([c for c, _, _ in routes], "string", "route"))
    )
    topic0 = (
        F.when((F.col("kind") == 18) & (F.col("contract") == MORPHO), F.lit(MINT))
        .when(F.col("kind") == 18, F.lit(MORPHO_SUPPLY))
        .when(F.col("case") == 7, F.lit("0x" + MINT[2:].upper()))
        .otherwise(by_def([t for _, t, _ in routes], "string", "route"))
    )
    address = (
        F.when(F.col("kind") == 17, F.lit(UNKNOWN_CONTRACT))
        .when(F.col("case") == 8, F.lit("0x" + CDAI[2:].upper()))
        .otherwise(F.col("contract"))
    )
    words = F.transform(
        _words([d.topic_fields for d in DEFAULT.definitions], 1),
        lambda w, i: F.when((F.col("case") == 13) & (i == 2), F.lit("0xzz")).otherwise(F.concat(F.lit("0x"), w)),
    )
    n_topics = F.when(F.col("case") == 5, 0).when(F.col("case") == 11, 3).otherwise(1 + DEFAULT.n_topics)
    topic_list = F.slice(F.concat(F.array(topic0), words), F.lit(1), n_topics)
    body = F.concat(F.lit("0x"), F.array_join(_words([d.data_fields for d in DEFAULT.definitions], 10), ""))
    return base.select(
        F.col("ts").cast("date").alias("date"),
        (F.col("k") + 18_000_000).alias("block_number"),
        F.col("ts").cast("timestamp").alias("block_timestamp"),
        F.expr("concat('0x', lpad(lower(hex(k)), 64, '0'))").alias("transaction_hash"),
        (F.col("k") % 500).alias("log_index"),
        address.alias("address"),
        F.when(F.col("case") == 6, F.lit(None)).otherwise(topic_list).alias("topics"),
        body.alias("body"),
        "case",
    ).select(
        *HEADER[:-1],
        F.when(F.col("case") == 0, F.substr("body", F.lit(1), F.length("body") - 64))
        .when(F.col("case") == 1, F.substr("body", F.lit(1), F.length("body") - 1))
        .when(F.col("case") == 2, F.concat(F.lit("0xzz"), F.substr("body", F.lit(5))))
        .when(F.col("case") == 3, F.lit(None))
        .when(F.col("case") == 4, F.lit(""))
        .when(F.col("case") == 9, F.concat("body", F.lit("f" * 64)))
        .when(F.col("case") == 10, F.concat(F.substr("body", F.lit(1), F.lit(66)), F.lit("f" * 64), F.substr("body", F.lit(131))))
        .when(F.col("case") == 12, F.concat(F.lit("0xff"), F.substr("body", F.lit(5))))
        .otherwise(F.col("body"))
        .alias("data"),
    )


def event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log per row of ``events``."""
    return encode_logs(spark.read.parquet(f"{sf_dir}/events.parquet"), F.col("event_id"), F.col("ts"))


def lineitem_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log per row of ``lineitem``; lines with the same order and line number give equal logs."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return encode_logs(lines, F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.col("l_shipdate"))
