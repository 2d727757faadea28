"""The registered queries: every operator over logs that Spark derives from the given tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from logloom import registry as reg
from logloom.functions import words
from logloom.operators import (
    dead_letter_rows,
    dead_letters,
    decode_logs,
    decode_status,
    decoded_logs,
    event_counts,
    filter_logs,
    known_spellings,
    shape,
    shape_deposit,
    table_rows,
    with_target,
)
from logloom.operators.shape import TABLES, EventTable
from logloom.plans import run
from logloom.sources import read_published, read_raw_logs
from logloom.sources.scratch import child_names, scratch_path
from logloom.registry import DEFAULT, Registry

from . import oracle
from .logs import MINT, POOL_V2, event_logs, lineitem_logs

RANGE = (date(2024, 1, 5), date(2024, 1, 20))
NEW_CONTRACT = "0x" + "22" * 20


def _comparable(rows: DataFrame) -> DataFrame:
    """Timestamps without zone and decimals as exact text, so that a client's number types do not matter."""
    exact = {f.name: F.col(f.name).cast("string") for f in rows.schema if isinstance(f.dataType, DecimalType)}
    if "block_timestamp" in rows.columns:
        exact["block_timestamp"] = F.col("block_timestamp").cast("timestamp_ntz")
    return rows.withColumns(exact)


def _raw_dataset(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark)
    event_logs(spark, sf_dir).hint("rebalance", F.col("date")).write.partitionBy("date").parquet(path)
    return path


def logs_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = read_raw_logs(spark, _raw_dataset(spark, sf_dir), *RANGE)
    return logs.groupBy("date").agg(
        F.count("*").alias("n"), F.min("block_number").alias("first_block"), F.max("block_number").alias("last_block")
    )


def _known_view(known: DataFrame) -> DataFrame:
    """All columns of known logs, the topics as one text."""
    return _comparable(known.select("block_number", "block_timestamp", "transaction_hash", "log_index", "date", "address", F.array_join("topics", ",").alias("topics"), "data"))


def logs_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _known_view(filter_logs(event_logs(spark, sf_dir)))


def logs_known_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows by the addresses as the source writes them, which the reader can skip row groups by."""
    logs = read_raw_logs(spark, _raw_dataset(spark, sf_dir), *_full_range(spark, sf_dir))
    return _known_view(filter_logs(logs, spellings=known_spellings(logs)))


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_logs(filter_logs(event_logs(spark, sf_dir)))


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_status(_decoded(spark, sf_dir))


def decode_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoded_logs(_decoded(spark, sf_dir)).select("block_number", F.explode("decoded").alias("name", "value"))


def _letter_view(letters: DataFrame) -> DataFrame:
    """Dead letters without array columns: the topics as one text."""
    return _comparable(letters).withColumn("topics", F.array_join("raw_topics", ",")).drop("raw_topics")


def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _letter_view(dead_letters(_decoded(spark, sf_dir)))


def typed_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _letter_view(dead_letter_rows(with_target(filter_logs(event_logs(spark, sf_dir)))))


def _map_table(table: EventTable):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _comparable(shape(decoded_logs(_decoded(spark, sf_dir)), table))

    return query


def _typed_table(table: EventTable):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _comparable(table_rows(with_target(filter_logs(event_logs(spark, sf_dir))), table))

    return query


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_counts(_decoded(spark, sf_dir))


def _written(spark: SparkSession, output: str) -> DataFrame:
    """Rows per table and date of everything the pipeline wrote."""
    return _counted({name: spark.read.parquet(f"{output}/{name}") for name in child_names(spark, output) if not name.startswith(("_", "."))})


def _counted(tables: dict[str, DataFrame]) -> DataFrame:
    merged = reduce(DataFrame.unionByName, [rows.select("date", F.lit(name).alias("table")) for name, rows in tables.items()])
    return merged.groupBy("date", "table").agg(F.count("*").alias("n"))


def _full_range(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    days = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    return days[0], days[1]


def pipeline_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Liquidations as they come back from staging and Parquet."""
    source, output = _raw_dataset(spark, sf_dir), scratch_path(spark)
    run(spark, source, output, *_full_range(spark, sf_dir))
    return _comparable(spark.read.parquet(f"{output}/liquidationcall"))


def pipeline_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters as they come back from staging and Parquet."""
    source, output = _raw_dataset(spark, sf_dir), scratch_path(spark)
    run(spark, source, output, *_full_range(spark, sf_dir))
    return _letter_view(spark.read.parquet(f"{output}/dead_letter"))


def pipeline_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, output = _raw_dataset(spark, sf_dir), scratch_path(spark)
    run(spark, source, output, *_full_range(spark, sf_dir))
    return _written(spark, output)


def pipeline_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The range in two runs, then part of it again: replaced days keep their rows once."""
    source, output = _raw_dataset(spark, sf_dir), scratch_path(spark)
    first, last = _full_range(spark, sf_dir)
    run(spark, source, output, first, RANGE[1], mode="overwrite_partitions")
    run(spark, source, output, RANGE[0], last, mode="overwrite_partitions", assume_lowercase=False)
    return _written(spark, output)


def pipeline_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run over logs whose payloads are cut short, then a run over the repaired ones: what is left."""
    output, broken = scratch_path(spark), scratch_path(spark)
    source = _raw_dataset(spark, sf_dir)
    logs = spark.read.parquet(source).withColumn("data", F.when(F.col("log_index") % 2 == 0, F.col("data")))
    logs.hint("rebalance", F.col("date")).write.partitionBy("date").parquet(broken)
    days = _full_range(spark, sf_dir)
    run(spark, broken, output, *days, mode="overwrite_partitions")
    run(spark, source, output, *days, mode="overwrite_partitions")
    return _written(spark, output)


def pipeline_text_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of the header as text, the schema taken from the files: deposits as written."""
    source, output = scratch_path(spark), scratch_path(spark)
    logs = event_logs(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in ("block_number", "log_index")})
    logs.hint("rebalance", F.col("date")).write.partitionBy("date").parquet(source)
    run(spark, source, output, *_full_range(spark, sf_dir), schema=None)
    return _comparable(spark.read.parquet(f"{output}/deposit"))


def pipeline_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other day has block numbers and positions as text, the schema is taken from the files: deposits as written."""
    source, output = scratch_path(spark), scratch_path(spark)
    logs, text = event_logs(spark, sf_dir), ("block_number", "log_index")
    for odd, part in ((0, logs), (1, logs.withColumns({c: F.col(c).cast("string") for c in text}))):
        part.where(F.dayofmonth("date") % 2 == odd).hint("rebalance", F.col("date")).write.partitionBy("date").mode("append").parquet(source)
    run(spark, source, output, *_full_range(spark, sf_dir), schema=None)
    return _comparable(spark.read.parquet(f"{output}/deposit"))


def pipeline_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All values of the five tables as written, each as a row of text."""
    source, output = _raw_dataset(spark, sf_dir), scratch_path(spark)
    run(spark, source, output, *_full_range(spark, sf_dir))
    return reduce(DataFrame.unionByName, [_values_of(spark.read.parquet(f"{output}/{t.name}"), t.name) for t in TABLES])


def _values_of(rows: DataFrame, name: str) -> DataFrame:
    shown = rows.withColumn("block_timestamp", F.unix_micros("block_timestamp"))
    values = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in rows.columns if c != "transaction_hash"]
    return shown.select(F.lit(name).alias("table"), "transaction_hash", F.inline(F.array(*values)))


def pipeline_append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part of the range, then all of it twice, each time only what is not there yet."""
    source, output = _raw_dataset(spark, sf_dir), scratch_path(spark)
    days = _full_range(spark, sf_dir)
    for first, last in (RANGE, days, days):
        run(spark, source, output, first, last, mode="append_new")
    return _written(spark, output)


def pipeline_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published states: a replaced range, then what is new in all of it, read at the last version."""
    source, output = _raw_dataset(spark, sf_dir), scratch_path(spark)
    days = _full_range(spark, sf_dir)
    for first, last, mode in ((*RANGE, "append"), (*RANGE, "overwrite_partitions"), (*days, "append_new"), (*days, "append_new")):
        run(spark, source, output, first, last, mode=mode, layout="snapshots")
    return _counted({name: read_published(spark, output, name) for name in [t.name for t in TABLES] + ["dead_letter"]})


def pipeline_empty_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of one event alone: of the tables, only those with rows are there to be counted."""
    source, output = scratch_path(spark), scratch_path(spark)
    logs = event_logs(spark, sf_dir).where(F.get("topics", F.lit(0)) == MINT)
    logs.hint("rebalance", F.col("date")).write.partitionBy("date").parquet(source)
    run(spark, source, output, *_full_range(spark, sf_dir))
    return _written(spark, output)


def decode_repeated_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A definition with a name in topics and data."""
    twice = replace(reg.aave.DEPOSIT_V2, data_fields=(("reserve", "address"), ("amount", "uint256")))
    one = Registry((((POOL_V2, (twice,)),),))
    decoded = decoded_logs(decode_logs(filter_logs(event_logs(spark, sf_dir), one), one))
    return decoded.select("block_number", F.explode("decoded").alias("name", "value"))


def added_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deposits decoded with one more protocol in front of the others, shaped without naming it."""
    extra = Registry((((NEW_CONTRACT, (replace(DEFAULT.definitions[0], version="new"),)),), *DEFAULT.protocols))
    return _comparable(shape_deposit(decoded_logs(decode_logs(filter_logs(event_logs(spark, sf_dir), extra), extra))))


def route_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reachable route with the number of known logs that take it."""
    listing = reg.route_listing(spark, DEFAULT).drop("signature")
    used = (
        filter_logs(event_logs(spark, sf_dir))
        .groupBy(F.lower("address").alias("contract"), F.get("topics", F.lit(0)).alias("topic0"))
        .agg(F.count("*").alias("n_logs"), F.min("block_number").alias("first_block"))
    )
    return listing.join(used, ["contract", "topic0"], "left").select(
        "contract", "event", "version", "topic0", "protocol", F.coalesce("n_logs", F.lit(0)).alias("n_logs"), "first_block"
    )


def contract_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts and first topics seen in the raw logs, against the sets of known ones."""
    topic0 = F.get("topics", F.lit(0))
    return (
        event_logs(spark, sf_dir)
        .groupBy(F.lower("address").alias("contract"))
        .agg(
            F.count("*").alias("n_logs"),
            F.countDistinct(topic0).alias("n_topic0s"),
            F.count(F.when(topic0.isin(DEFAULT.topic0s), 1)).alias("n_known_topic0"),
        )
        .select("contract", F.col("contract").isin(DEFAULT.contracts).alias("known_contract"), "n_logs", "n_topic0s", "n_known_topic0")
    )


def _topic(value: str, digits: int = 64) -> Column:
    return F.expr(f"concat('0x', lpad(hex({value}), {digits}, '0'))")


def word_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each type's reading of topics made from ``event_id``."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("k"))
    topics = {
        "as_address": (_topic("k * 31 + 7"), "address"),
        "as_bool": (_topic("k % 3"), "bool"),
        "as_uint256": (F.expr("concat('0x', lpad(hex(k % 1000003), 48, '0'), lpad(hex(k * 97), 16, '0'))"), "uint256"),
        "as_int256": (F.expr("concat(repeat('f', 48), lower(hex(-1 - k)))"), "int256"),
        "as_int8": (_topic("k % 256", 2), "int8"),
        "as_bytes4": (F.expr("concat('0x', lpad(lower(hex(k)), 8, '0'), repeat('0', 56))"), "bytes4"),
        "as_long": (F.expr("concat('0x', lpad(hex(k + 1), 16, '0'), repeat('0', 64))"), "uint256"),
        "as_other": (_topic("k"), "other"),
    }
    # a step reads columns that the one before computed; one number a step keeps the code of a step small enough to be compiled
    rows = events.select("k", *[topic.alias(name) for name, (topic, _) in topics.items()])
    for name, (_, kind) in topics.items():
        if "int" in kind:
            rows = rows.withColumn(name, words.topic_text(F.col(name), kind))
            rows = rows.withColumn(name, words.finish_text(F.col(name)))
    return rows.withColumns({name: words.topic_text(F.col(name), kind) for name, (_, kind) in topics.items() if "int" not in kind})


def data_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven shapes of payload against the strict word checks."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias("k"), (F.col("event_id") % 7).alias("shape")
    )
    payload = F.expr(
        """CASE shape WHEN 0 THEN '0x' WHEN 1 THEN concat('0x', lpad(hex(k + 256), 64, '0')) WHEN 2 THEN '0x123'
           WHEN 3 THEN concat('0x', rpad(hex(k + 1), 64, '0')) WHEN 4 THEN concat('0x', repeat('f', 64))
           WHEN 5 THEN concat('0x', repeat('z', 64)) ELSE lpad(hex(k % 2), 64, '0') END"""
    )
    data = words.data_bytes(payload)
    word = words.data_word(data, 0)

    def strict(kind: str) -> Column:
        return F.coalesce((F.octet_length(data) >= 32) & words.is_strict_word(word, kind), F.lit(False))

    return (
        events.select(
            "shape",
            F.octet_length(data).alias("n_bytes"),
            strict("address").alias("is_address"),
            strict("uint8").alias("is_uint8"),
            strict("bool").alias("is_bool"),
        )
        .groupBy("shape", "n_bytes", "is_address", "is_uint8", "is_bool")
        .agg(F.count("*").alias("n"))
    )


def deposit_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deposits per day and contract, over logs made from ``lineitem``."""
    deposits = shape_deposit(decoded_logs(decode_logs(filter_logs(lineitem_logs(spark, sf_dir)))))
    totals = deposits.groupBy("date", "project_contract").agg(
        F.count("*").alias("n_deposits"), F.sum("amount").alias("total_amount")
    )
    return _comparable(totals)


QUERIES = {
    "logs_date_range": logs_date_range,
    "logs_known": logs_known,
    "logs_known_spellings": logs_known_spellings,
    "route_usage": route_usage,
    "contract_usage": contract_usage,
    "word_values": word_values,
    "data_checks": data_checks,
    "decode_status": status,
    "decode_fields": decode_fields,
    "dead_letter": dead_letter,
    "typed_dead_letter": typed_dead_letter,
    "event_counts": counts,
    "pipeline_roundtrip": pipeline_roundtrip,
    "pipeline_rerun": pipeline_rerun,
    "pipeline_repair": pipeline_repair,
    "pipeline_values": pipeline_values,
    "pipeline_letters": pipeline_letters,
    "pipeline_text_types": pipeline_text_types,
    "pipeline_mixed_types": pipeline_mixed_types,
    "pipeline_tables": pipeline_tables,
    "pipeline_append_new": pipeline_append_new,
    "pipeline_snapshots": pipeline_snapshots,
    "pipeline_empty_tables": pipeline_empty_tables,
    "decode_repeated_names": decode_repeated_names,
    "added_protocol": added_protocol,
    "deposit_totals": deposit_totals,
}
_NAMES = {"deposit": "deposits", "withdraw": "withdrawals", "borrow": "borrows", "repay": "repays", "liquidationcall": "liquidations"}
for _table in TABLES:
    QUERIES[_NAMES[_table.name]] = _map_table(_table)
    QUERIES[f"typed_{_NAMES[_table.name]}"] = _typed_table(_table)


def oracle_queries() -> dict[str, str]:
    written = oracle.event_counts(by_date=True, written=True)
    sql = {
        "logs_date_range": oracle.logs_date_range(*map(str, RANGE)),
        "logs_known": oracle.logs_known(),
        "logs_known_spellings": oracle.logs_known(),
        "route_usage": oracle.route_usage(),
        "contract_usage": oracle.contract_usage(),
        "word_values": oracle.word_values(),
        "data_checks": oracle.data_checks(),
        "decode_status": oracle.decode_status(),
        "decode_fields": oracle.decode_fields(),
        "dead_letter": oracle.dead_letter(),
        "typed_dead_letter": oracle.dead_letter(),
        "event_counts": oracle.event_counts(),
        "pipeline_roundtrip": written,
        "pipeline_rerun": written,
        "pipeline_repair": written,
        "pipeline_values": oracle.shaped("liquidationcall"),
        "pipeline_letters": oracle.dead_letter(),
        "pipeline_text_types": oracle.shaped("deposit"),
        "pipeline_mixed_types": oracle.shaped("deposit"),
        "pipeline_tables": oracle.all_shaped(),
        "pipeline_append_new": written,
        "pipeline_snapshots": written,
        "pipeline_empty_tables": oracle.mint_counts(),
        "decode_repeated_names": oracle.repeated_names(),
        "added_protocol": oracle.shaped("deposit"),
        "deposit_totals": oracle.deposit_totals(),
    }
    for table, name in _NAMES.items():
        sql[name] = sql[f"typed_{name}"] = oracle.shaped(table)
    return sql
