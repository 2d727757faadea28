"""Ethereum event logs to lending-market tables, on Spark."""

from .operators import (
    dead_letters,
    decode_logs,
    decoded_logs,
    event_counts,
    filter_logs,
    shape_borrow,
    shape_deposit,
    shape_liquidation,
    shape_repay,
    shape_withdraw,
)
from .plans import run
from .registry import DEFAULT, Registry, define
from .sources import read_published, read_raw_logs, remove_unpublished, write_table

__all__ = [
    "DEFAULT",
    "Registry",
    "dead_letters",
    "decode_logs",
    "decoded_logs",
    "define",
    "event_counts",
    "filter_logs",
    "read_published",
    "read_raw_logs",
    "remove_unpublished",
    "run",
    "shape_borrow",
    "shape_deposit",
    "shape_liquidation",
    "shape_repay",
    "shape_withdraw",
    "write_table",
]
