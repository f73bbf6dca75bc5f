from feeloom.sinks.tables import (
    AmbiguousUpsert,
    align_schema,
    overwrite_table,
    publish,
    table_report,
    upsert_by_partition,
)

__all__ = [
    "AmbiguousUpsert",
    "align_schema",
    "overwrite_table",
    "publish",
    "table_report",
    "upsert_by_partition",
]
