from .counts import decode_status, event_counts
from .decode import check_logs, dead_letters, decode_logs, decoded_logs, route_logs
from .filters import filter_logs, known_spellings
from .fresh import rows_not_in
from .shape import shape, shape_borrow, shape_deposit, shape_liquidation, shape_repay, shape_withdraw
from .typed import dead_letter_rows, table_rows, with_target

__all__ = [
    "check_logs",
    "dead_letter_rows",
    "dead_letters",
    "decode_logs",
    "decode_status",
    "decoded_logs",
    "event_counts",
    "filter_logs",
    "known_spellings",
    "route_logs",
    "rows_not_in",
    "shape",
    "shape_borrow",
    "shape_deposit",
    "shape_liquidation",
    "shape_repay",
    "shape_withdraw",
    "table_rows",
    "with_target",
]
