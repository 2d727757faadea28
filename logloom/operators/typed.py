"""The event tables straight from checked logs, without the text map.

``decode_logs`` and ``shape`` build every field of a log as text, then cast what a table keeps.
Here each output column finds the position of its word through the log's definition and converts
that one word to the column's type: plain expressions that stay in whole-stage code generation, and
only the columns that are read are computed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import words
from ..registry import DEFAULT, EventDef, Registry
from ..registry.model import by_def
from .decode import DATA, check_logs, dead_letter_columns
from .shape import DEAD_LETTER, TABLES, EventTable, ShapedColumn, header, table_of_label

Source = tuple[str, int, str]  # ("topic" or "data", position, type)


def with_target(logs: DataFrame, registry: Registry = DEFAULT, tables: tuple[EventTable, ...] = TABLES) -> DataFrame:
    """Checks the logs and names the output table of each: an event table, unshaped, or dead_letter."""
    owners = by_def([table_of_label(d.event, tables) for d in registry.definitions], "string")
    target = F.when(F.col("log_error").isNull(), owners).otherwise(F.lit(DEAD_LETTER))
    return check_logs(logs, registry).withColumn("target", target)


def table_rows(targeted: DataFrame, table: EventTable, registry: Registry = DEFAULT) -> DataFrame:
    """The rows of one event table, from logs with a ``target``."""
    defs = registry.definitions
    rows = targeted.where(F.col("target") == table.name)
    if DATA not in rows.columns:
        rows = rows.withColumn(DATA, words.data_bytes(F.col("data")))
    return rows.select(
        *header(by_def([d.protocol for d in defs], "string"), by_def([d.version for d in defs], "string"), F.lower("address")),
        *[_column(spec, table, registry).alias(spec.name) for spec in table.columns],
    )


def dead_letter_rows(targeted: DataFrame) -> DataFrame:
    """The dead letters, from logs with a ``target``."""
    rows = targeted.where(F.col("target") == DEAD_LETTER)
    return rows.select(*dead_letter_columns(F.col("log_error"), F.col("topics"), F.col("data")))


def _column(spec: ShapedColumn, table: EventTable, registry: Registry) -> Column:
    sources = [_sources(d, spec) if d.event in table.labels else [] for d in registry.definitions]
    kinds = [found[0][2] if found else None for found in sources]
    distinct = sorted({k for k in kinds if k})
    if not distinct:
        return F.lit(None).cast(spec.sql_type)
    topic, data = _topic(sources), _data_word(sources)
    if len(distinct) == 1:
        return _value(topic, data, distinct[0], spec.sql_type)
    kind = by_def(kinds, "string")
    return F.coalesce(*[F.when(kind == one, _value(topic, data, one, spec.sql_type)) for one in distinct])


def _sources(definition: EventDef, spec: ShapedColumn) -> list[Source]:
    """Where the column's value may come from, best first.

    A topic may be missing from a log, so the next key stands in for it; a data word is always there.
    """
    places: dict[str, Source] = {n: ("topic", p, k) for p, (n, k) in enumerate(definition.topic_fields, 1)}
    places |= {n: ("data", p, k) for p, (n, k) in enumerate(definition.data_fields)}
    found = [places[key] for key in spec.keys if key in places]
    first_data = next((i for i, s in enumerate(found) if s[0] == "data"), len(found))
    found = found[: first_data + 1]
    if len({kind for _, _, kind in found}) > 1:
        raise ValueError(f"{definition.event} {definition.version}: {spec.name} mixes types {found}")
    return found


def _topic(sources: list[list[Source]]) -> Column | None:
    """The first topic a row's definition names for the column that the log really has."""
    per_def = [[p for kind, p, _ in found if kind == "topic"] for found in sources]
    ranks = range(max(map(len, per_def)))
    choices = [F.get("topics", by_def([p[r] if r < len(p) else None for p in per_def], "int")) for r in ranks]
    return F.coalesce(*choices) if choices else None


def _data_word(sources: list[list[Source]]) -> Column | None:
    positions = [next((p for kind, p, _ in found if kind == "data"), None) for found in sources]
    if all(p is None for p in positions):
        return None
    return words.data_word(F.col(DATA), by_def(positions, "int"))


def _value(topic: Column | None, data: Column | None, kind: str, sql_type: str) -> Column:
    if topic is None:
        return _data_value(data, kind, sql_type)
    from_topic = _topic_value(topic, kind, sql_type)
    if data is None:
        return from_topic
    return F.when(topic.isNotNull(), from_topic).otherwise(_data_value(data, kind, sql_type))


_DIRECT = {
    ("uint", "decimal(38,0)"): words.uint_decimal,
    ("uint", "bigint"): words.uint_bigint,
    ("uint", "int"): words.uint_int,
    ("bool", "boolean"): words.boolean,
}


def _topic_value(topic: Column, kind: str, sql_type: str) -> Column:
    direct = _DIRECT.get(("uint" if kind.startswith("uint") else kind, sql_type))
    return direct(words.topic_word(topic)) if direct else _as_type(words.topic_text(topic, kind), kind, sql_type)


def _data_value(word: Column, kind: str, sql_type: str) -> Column:
    direct = _DIRECT.get(("uint" if kind.startswith("uint") else kind, sql_type))
    return direct(word) if direct else _as_type(words.data_text(word, kind), kind, sql_type)


def _as_type(text: Column, kind: str, sql_type: str) -> Column:
    if kind.startswith(("uint", "int")):
        text = words.finish_text(text)
    return text if sql_type == "string" else text.try_cast(sql_type)
