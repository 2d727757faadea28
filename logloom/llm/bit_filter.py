"""A broadcast bit table of fixed size that tells which 64-bit keys cannot be in a set.

The table has ``2 ** bits`` flags whatever the size of the set, so the broadcast is bounded by construction. The
larger the set, the more other keys pass; every user joins what passes with the set itself, so the results
never depend on the filter, only the number of rows that reach the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.storage import staged
from logloom.llm.workers import lean

BITS = 27
_SEGMENTS = 6


class BitFilter:
    def __init__(self, flags: np.ndarray, bits: int):
        self.flags, self.bits = flags, bits

    def may_have(self, keys: np.ndarray) -> np.ndarray:
        """Flags of the uint64 keys that may be in the set."""
        at = keys >> np.uint64(64 - self.bits)
        return (self.flags[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def broadcast_filter(keys: DataFrame, bits: int = BITS):
    """The filter over the single long column of ``keys``, as a broadcast variable.

    The flags are gathered as 64-bit words by a grouped sum (at most ``2 ** (bits - 6)`` rows, however many keys),
    then as 64 segments, ``2 ** (bits - 3)`` bytes, which go to the driver by way of the shared folder, so that the
    shuffle files of the keys do not outlast the filter's making.
    """
    spark = keys.sparkSession
    key = keys.columns[0]
    words = keys.groupBy(F.expr(f"shiftrightunsigned(`{key}`, {64 - bits + 6})").alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(`{key}`, {64 - bits}) & 63 as int)))").alias("flags")
    )
    per_segment = 1 << (bits - 6 - _SEGMENTS)

    def segments(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, np.ndarray] = {}
        for part in rows:
            for segment, own in part.groupby(part["word"] // per_segment):
                flags = found.setdefault(int(segment), np.zeros(per_segment, dtype=np.int64))
                flags[own["word"] % per_segment] = own["flags"]
        yield pd.DataFrame({"segment": list(found), "flags": [f.tobytes() for f in found.values()]})

    by_segment = words.repartition(F.shiftrightunsigned("word", bits - 6 - _SEGMENTS)).mapInPandas(lean(segments), "segment long, flags binary")
    flags = np.zeros((1 << _SEGMENTS, per_segment), dtype=np.int64)
    for row in staged(by_segment).toLocalIterator():
        flags[row["segment"]] = np.frombuffer(row["flags"], dtype=np.int64)
    return spark.sparkContext.broadcast(BitFilter(flags.view(np.uint8).ravel(), bits))
