from feeloom.sources.csv_files import quarantine_fees_csv, read_fees_csv, require_not_null
from feeloom.sources.tables import (
    high_water_mark,
    newest_partition,
    read_partitions,
    read_table,
    table_exists,
    table_path,
)

__all__ = [
    "high_water_mark",
    "newest_partition",
    "quarantine_fees_csv",
    "read_fees_csv",
    "read_partitions",
    "read_table",
    "require_not_null",
    "table_exists",
    "table_path",
]
