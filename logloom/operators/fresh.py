"""Rows that a table does not have yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What tells a log from all others.
LOG_KEY = ("transaction_hash", "log_index")
# Flags of the broadcast bit table: 2 ** 24 of them in at most 2 ** 18 rows, whatever the table's size.
BITS = 24

_KEYS = "_fresh_key_{}"


def _keys(names: tuple[str, ...]) -> list[Column]:
    """As text, since a table may hold a number in another type than the rows."""
    return [F.col(name).cast("string").alias(_KEYS.format(i)) for i, name in enumerate(names)]


def _place(names: tuple[str, ...], bits: int) -> tuple[Column, Column]:
    """(row of the bit table, flag in it) of a key."""
    place = F.shiftrightunsigned(F.xxhash64(*_keys(names)), 64 - bits)
    return F.shiftrightunsigned(place, 6), F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))


def rows_not_in(rows: DataFrame, existing: DataFrame, key: tuple[str, ...] = LOG_KEY, bits: int = BITS) -> DataFrame:
    """The rows whose key ``existing`` does not have, in any order; among themselves they may repeat.

    A broadcast bit table over the existing keys (a Bloom filter of one hash) passes most new rows without a shuffle. The others
    are joined with the existing keys, which decides; so a full bit table costs time only. A key with a null in it
    equals no other: such rows are always new.
    """
    word, flag = _place(key, bits)
    table = existing.select(word.alias("_fresh_word"), flag.alias("_fresh_flag")).groupBy("_fresh_word").agg(F.bit_or("_fresh_flag").alias("_fresh_flags"))
    marked = rows.join(F.broadcast(table), word == F.col("_fresh_word"), "left").withColumn(
        "_fresh_maybe", F.coalesce(F.col("_fresh_flags").bitwiseAND(flag) != 0, F.lit(False))
    )
    known = existing.select(*_keys(key))
    maybe = marked.where("_fresh_maybe")
    on = [F.col(name).cast("string") == known[_KEYS.format(i)] for i, name in enumerate(key)]
    checked = maybe.join(known, on, "left_anti")
    return marked.where(~F.col("_fresh_maybe")).unionByName(checked).select(*rows.columns)
