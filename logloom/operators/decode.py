"""Routing logs to event definitions and decoding them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import words
from ..registry import DEFAULT, Registry, broadcast_routes
from ..registry.model import METADATA, by_def

# Fixed value: the error text of every log without a route or with bad data.
NOT_DECODED = "No matching ABI or decode_log returned None"
BAD_TOPIC = "invalid topic word at position {}"

# columns that exist only between the steps of decoding
DATA = "_data_bytes"
VALUES = "_values"


def route_logs(logs: DataFrame, registry: Registry = DEFAULT) -> DataFrame:
    """Adds ``def_id`` by a left join with the route table; NULL where no definition matches."""
    table = broadcast_routes(logs.sparkSession, registry).select(
        F.col("contract").alias("_contract"), F.col("topic0").alias("_topic0"), "def_id"
    )
    on = (F.lower(logs["address"]) == table["_contract"]) & (
        F.lower(F.get(logs["topics"], F.lit(0))) == table["_topic0"]
    )
    return logs.join(table, on, "left").drop("_contract", "_topic0")


def check_logs(logs: DataFrame, registry: Registry = DEFAULT) -> DataFrame:
    """Adds ``def_id``, the data as bytes, and ``log_error``: why the log cannot be decoded, or NULL."""
    routed = route_logs(logs, registry).withColumn(DATA, words.data_bytes(F.col("data")))
    return routed.withColumn("log_error", _log_error(registry))


def _log_error(registry: Registry) -> Column:
    routed = F.col("def_id").isNotNull() & (F.size("topics") > 0)
    checks = F.when(~F.coalesce(routed, F.lit(False)), F.lit(NOT_DECODED))
    for position in range(1, registry.n_topics + 1):
        checks = checks.when(_bad_topic(registry, position), F.lit(BAD_TOPIC.format(position)))
    return checks.when(~F.coalesce(_good_data(registry), F.lit(False)), F.lit(NOT_DECODED))


def _kinds(registry: Registry, source: str, position: int) -> list[str | None]:
    """The type each definition declares at a topic position (from 1) or data position (from 0)."""
    lists = [d.topic_fields if source == "topic" else d.data_fields for d in registry.definitions]
    index = position - 1 if source == "topic" else position
    return [fields[index][1] if index < len(fields) else None for fields in lists]


def _bad_topic(registry: Registry, position: int) -> Column:
    """A topic that is there but is NULL, or is not a number where a number is declared."""
    topic = F.get("topics", F.lit(position))
    kinds = _kinds(registry, "topic", position)
    bad = topic.isNull()
    if any(k and words.is_numeric(k) for k in kinds):
        numeric = by_def([bool(k and words.is_numeric(k)) for k in kinds], "boolean")
        bad = bad | (numeric & ~words.is_number_topic(topic))
    return by_def([k is not None for k in kinds], "boolean") & (F.size("topics") > position) & bad


def _good_data(registry: Registry) -> Column:
    """Hex bytes, long enough for every declared word, each word padded as its type demands.

    Bytes beyond the declared words are accepted.
    """
    data = F.col(DATA)
    needed = by_def([words.WORD * len(d.data_fields) for d in registry.definitions], "int")
    checks = [data.isNotNull(), F.octet_length(data) >= needed]
    for position in range(registry.n_words):
        kinds = _kinds(registry, "data", position)
        for kind in sorted({k for k in kinds if k}):
            strict = words.is_strict_word(words.data_word(data, position), kind)
            if strict is not None:
                checks.append(~by_def([k == kind for k in kinds], "boolean") | strict)
    return (needed == 0) | reduce(lambda a, b: a & b, checks)


def decode_logs(logs: DataFrame, registry: Registry = DEFAULT) -> DataFrame:
    """Adds ``decode_result``: ``success``, the decoded fields as a text map, or the error and raw input.

    ``def_id`` and ``event`` stay as columns: the definition the log was decoded with, and its label.
    """
    checked = check_logs(logs, registry)
    ok = F.col("log_error").isNull()
    values = checked.withColumn(VALUES, F.when(ok, _values(registry)))
    # a row without wide words never enters the interpreted lambda, and its argument is computed already
    texts = F.when(
        F.concat_ws("", VALUES).contains(words.WIDE_MARK), F.transform(VALUES, words.finish_text)
    ).otherwise(F.col(VALUES))
    result = F.struct(
        ok.alias("success"),
        F.map_from_arrays(_names(registry), texts).alias("data"),
        F.col("log_error").alias("error"),
        F.when(~ok, F.col("topics")).alias("raw_topics"),
        F.when(~ok, F.col("data")).alias("raw_data"),
    )
    event = by_def([d.event for d in registry.definitions], "string")
    return values.withColumn("decode_result", result).withColumn("event", event).drop("log_error", DATA, VALUES)


def _names(registry: Registry) -> Column:
    names = [[*METADATA, *(d.field_names[i] for i in d.kept_fields)] for d in registry.definitions]
    return by_def(names, "array<string>")


def _values(registry: Registry) -> Column:
    """Metadata, then the topic fields, then the data fields.

    Every position is decoded by one expression that picks the type of the row's definition, so
    the plan grows with the number of positions (15), not with definitions x fields.
    """
    defs = registry.definitions
    metadata = F.array(
        by_def([d.event for d in defs], "string"),
        by_def([d.version for d in defs], "string"),
        F.lower("address"),
        by_def([d.protocol for d in defs], "string"),
    )
    topics = [_text(registry, "topic", p, F.get("topics", F.lit(p))) for p in range(1, registry.n_topics + 1)]
    data = [_text(registry, "data", p, words.data_word(F.col(DATA), p)) for p in range(registry.n_words)]
    fields = F.concat(
        F.slice(F.array(*topics), F.lit(1), by_def([len(d.topic_fields) for d in defs], "int")),
        F.slice(F.array(*data), F.lit(1), by_def([len(d.data_fields) for d in defs], "int")),
    )
    if any(len(d.kept_fields) < len(d.field_names) for d in defs):  # a registry without repeated names has no need of it
        fields = F.transform(by_def([d.kept_fields for d in defs], "array<int>"), lambda i: F.get(fields, i))
    return F.concat(metadata, fields)


def _text(registry: Registry, source: str, position: int, raw: Column) -> Column:
    kinds = _kinds(registry, source, position)
    kind = by_def(kinds, "string")
    decode = words.topic_text if source == "topic" else words.data_text
    text = F.lit(None).cast("string")
    for one in sorted({k for k in kinds if k}):
        text = F.when(kind == one, decode(raw, one)).otherwise(text)
    return text


def decoded_logs(decoded: DataFrame) -> DataFrame:
    """The logs that decoded, with the payload as ``decoded``."""
    return decoded.where(F.col("decode_result.success")).withColumn("decoded", F.col("decode_result.data"))


def dead_letters(decoded: DataFrame) -> DataFrame:
    """The logs that did not decode, with the reason and their raw input."""
    result = F.col("decode_result")
    return decoded.where(~result["success"]).select(*dead_letter_columns(result["error"], result["raw_topics"], result["raw_data"]))


def dead_letter_columns(error: Column, topics: Column, data: Column) -> list[Column]:
    header = ["block_number", "block_timestamp", "transaction_hash", "log_index", "date", "address"]
    return [*map(F.col, header), error.alias("error"), topics.alias("raw_topics"), data.alias("raw_data")]
