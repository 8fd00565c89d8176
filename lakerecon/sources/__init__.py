from .catalog import catalog_view, table_partitions
from .files import has_rows, partition_exists, read_calendar, read_events, read_partitions
from .increments import HighWater, read_increment
from .jdbc import hash_predicates, read_jdbc, read_jdbc_hashed
from .listing import list_calendar, list_files, list_partitions, list_undated

__all__ = [
    "HighWater",
    "catalog_view",
    "has_rows",
    "hash_predicates",
    "list_calendar",
    "list_files",
    "list_partitions",
    "list_undated",
    "partition_exists",
    "read_calendar",
    "read_events",
    "read_increment",
    "read_jdbc",
    "read_jdbc_hashed",
    "read_partitions",
    "table_partitions",
]
