"""What an event definition is, and the registry as DataFrames."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Registry tables are broadcast only up to this many rows; larger ones are joined by a sort-merge join.
MAX_BROADCAST_ROWS = 200_000

# What every payload says of its definition.
METADATA = ("_event", "_version", "_contract", "_protocol")

Field = tuple[str, str]  # (name, solidity type)

DEFINITION_ROW = (
    "struct<def_id:int,protocol:string,version:string,event:string,signature:string,topic0:string,"
    "fields:array<struct<name:string,type:string,src:string,pos:int>>>"
)
CONTRACT_ROW = "struct<contract:string,protocol_rank:int,def_ids:array<int>>"


@dataclass(frozen=True)
class EventDef:
    """One event layout. Topic fields sit at topics 1, 2, ...; data fields at data words 0, 1, ...

    A name may be used again: the last field of the name is the one that is decoded, data coming after topics. The others
    are still checked.
    """

    protocol: str
    version: str
    event: str
    signature: str
    topic0: str
    topic_fields: tuple[Field, ...]
    data_fields: tuple[Field, ...]

    def __post_init__(self) -> None:
        taken = set(METADATA) & set(self.field_names)
        if taken:
            raise ValueError(f"{self.event} {self.version}: {sorted(taken)} are names of the payload's own")

    @property
    def field_names(self) -> list[str]:
        return [name for name, _ in self.topic_fields + self.data_fields]

    @property
    def kept_fields(self) -> list[int]:
        """Positions, topics first, of the last field of each name."""
        return sorted({name: i for i, name in enumerate(self.field_names)}.values())


def define(protocol: str, version: str, event: str, signature: str, topic0: str, topics: str, data: str) -> EventDef:
    """``topics`` and ``data`` are written like a DDL column list: ``"reserve address, amount uint256"``."""
    return EventDef(protocol, version, event, signature, topic0.lower(), _fields(topics), _fields(data))


def _fields(ddl: str) -> tuple[Field, ...]:
    pairs = (item.split() for item in ddl.split(",") if item.strip())
    return tuple((name, kind) for name, kind in pairs)


@dataclass(frozen=True)
class Registry:
    """Per protocol, the (contract, definitions) pairs in list order.

    When several definitions share a contract and topic0, the last one listed wins, and a later
    protocol wins over an earlier one.
    """

    protocols: tuple[tuple[tuple[str, tuple[EventDef, ...]], ...], ...]

    @cached_property
    def definitions(self) -> tuple[EventDef, ...]:
        """Distinct definitions; the position in this tuple is the ``def_id``."""
        listed = (d for protocol in self.protocols for _, defs in protocol for d in defs)
        return tuple(dict.fromkeys(listed))

    @cached_property
    def contracts(self) -> list[str]:
        return sorted({contract.lower() for protocol in self.protocols for contract, _ in protocol})

    @cached_property
    def topic0s(self) -> list[str]:
        return sorted({d.topic0 for d in self.definitions})

    @cached_property
    def n_listed(self) -> int:
        """Contract x definition pairs before last-wins: an upper bound of the route count."""
        return sum(len(defs) for protocol in self.protocols for _, defs in protocol)

    @property
    def n_topics(self) -> int:
        return max(len(d.topic_fields) for d in self.definitions)

    @property
    def n_words(self) -> int:
        return max(len(d.data_fields) for d in self.definitions)

    def with_protocol(self, *contracts: tuple[str, tuple[EventDef, ...]]) -> Registry:
        """A registry with one more protocol."""
        return Registry(self.protocols + (contracts,))


def constant(value: object, sql_type: str) -> Column:
    """A nested driver constant as one foldable literal, whatever its size."""
    return F.from_json(F.lit(json.dumps(value)), sql_type)


def by_def(values: list, sql_type: str, def_id: Column | str = "def_id") -> Column:
    """Per-definition constant: ``values[def_id]``, NULL where there is no route."""
    return F.get(constant(values, f"array<{sql_type}>"), F.col(def_id) if isinstance(def_id, str) else def_id)


def _constant_table(spark: SparkSession, rows: list[dict], row_type: str) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(F.inline(constant(rows, f"array<{row_type}>")))


def event_definitions(spark: SparkSession, registry: Registry) -> DataFrame:
    """One row per definition, shadowed ones included."""
    rows = [
        {
            "def_id": i,
            "protocol": d.protocol,
            "version": d.version,
            "event": d.event,
            "signature": d.signature,
            "topic0": d.topic0,
            "fields": [{"name": n, "type": t, "src": "topic", "pos": p} for p, (n, t) in enumerate(d.topic_fields, 1)]
            + [{"name": n, "type": t, "src": "data", "pos": p} for p, (n, t) in enumerate(d.data_fields)],
        }
        for i, d in enumerate(registry.definitions)
    ]
    return _constant_table(spark, rows, DEFINITION_ROW)


def contract_definitions(spark: SparkSession, registry: Registry) -> DataFrame:
    """(contract, protocol_rank, ord, def_id): every listed pair of all protocols."""
    ids = {d: i for i, d in enumerate(registry.definitions)}
    per_protocol = [
        _constant_table(
            spark,
            [
                {"contract": contract.lower(), "protocol_rank": rank, "def_ids": [ids[d] for d in defs]}
                for contract, defs in dict(protocol).items()  # a contract listed twice keeps its later list
            ],
            CONTRACT_ROW,
        )
        for rank, protocol in enumerate(registry.protocols)
    ]
    merged = per_protocol[0]
    for other in per_protocol[1:]:
        merged = merged.unionByName(other)
    return merged.select("contract", "protocol_rank", F.posexplode("def_ids").alias("ord", "def_id"))


def routes(spark: SparkSession, registry: Registry) -> DataFrame:
    """(contract, topic0) -> def_id, unique on its key."""
    # one partition: the constant table is tiny and the group-by then needs no exchange
    listed = contract_definitions(spark, registry).coalesce(1)
    topic0 = by_def([d.topic0 for d in registry.definitions], "string")
    return (
        listed.withColumn("topic0", topic0)
        .groupBy("contract", "topic0")
        .agg(F.max_by("def_id", F.struct("protocol_rank", "ord")).alias("def_id"))
    )


def _broadcast_within_bound(table: DataFrame, max_rows: int) -> DataFrame:
    # Catalyst takes the table for a tiny one, whatever its rows, so the other way must be asked for, too
    return table.hint("broadcast" if max_rows <= MAX_BROADCAST_ROWS else "merge")


def broadcast_routes(spark: SparkSession, registry: Registry) -> DataFrame:
    """The route table, to be broadcast only while its size is within the bound."""
    return _broadcast_within_bound(routes(spark, registry), registry.n_listed)


def route_listing(spark: SparkSession, registry: Registry) -> DataFrame:
    """Contract, event, version, topic0 of every reachable route, in (contract, topic0) order."""
    definitions = event_definitions(spark, registry).drop("topic0", "fields")
    return (
        routes(spark, registry)
        .join(_broadcast_within_bound(definitions, len(registry.definitions)), "def_id")
        .select("contract", "event", "version", "topic0", "protocol", "signature")
        .orderBy("contract", "topic0")
    )
