from .outputs import FOLDERS, LAYOUTS, SNAPSHOTS
from .raw_logs import RAW_SCHEMA, read_raw_logs
from .sinks import APPEND, APPEND_NEW, OVERWRITE_PARTITIONS, append_jdbc, write_table
from .snapshots import ConcurrentChange, read_published, remove_unpublished

__all__ = [
    "APPEND",
    "APPEND_NEW",
    "ConcurrentChange",
    "FOLDERS",
    "LAYOUTS",
    "OVERWRITE_PARTITIONS",
    "RAW_SCHEMA",
    "SNAPSHOTS",
    "append_jdbc",
    "read_published",
    "read_raw_logs",
    "remove_unpublished",
    "write_table",
]
