"""Row filters over raw logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..registry import DEFAULT, Registry


# Spellings of known addresses that a filter lists at most.
MAX_SPELLINGS = 1_000


def known_spellings(logs: DataFrame, registry: Registry = DEFAULT, most: int = MAX_SPELLINGS) -> list[str] | None:
    """How the known contracts are written in these logs, from a scan of the address column alone.

    None where there are more than ``most`` spellings; nothing beyond that number reaches the driver.
    """
    known = logs.select("address").where(F.lower("address").isin(registry.contracts)).distinct().limit(most + 1)
    found = [row["address"] for row in known.collect()]
    return sorted(found) if len(found) <= most else None


def filter_logs(
    logs: DataFrame, registry: Registry = DEFAULT, assume_lowercase: bool = False, spellings: list[str] | None = None
) -> DataFrame:
    """Logs of a known contract whose first topic is a known event hash.

    The two tests are independent: a known contract with another protocol's event passes here and
    becomes a dead letter. The address is compared in lower case, the hash as it stands. Set
    ``assume_lowercase`` when the source stores lower-case addresses, or give the ``spellings`` that ``known_spellings`` found
    in these logs: the bare column then reaches the Parquet reader as a pushed filter.
    """
    if spellings is not None:
        contract = F.col("address").isin(spellings)
    elif assume_lowercase:
        contract = F.col("address").isin(registry.contracts)
    else:
        contract = F.lower("address").isin(registry.contracts)
    return logs.where(contract).where(F.get("topics", F.lit(0)).isin(registry.topic0s))
