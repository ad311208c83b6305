"""Writers: CSV, Parquet, catalog tables and the published dataset."""

from askmill.sinks.files import append_csv, column_list, counted_write, export_parquet, preview, publish, write_csv, write_parquet
from askmill.sinks.tables import (
    append_to_table,
    create_table_as,
    drop_table,
    list_tables,
    table_to_parquet,
)

__all__ = [
    "append_csv",
    "append_to_table",
    "column_list",
    "counted_write",
    "create_table_as",
    "drop_table",
    "export_parquet",
    "list_tables",
    "preview",
    "publish",
    "table_to_parquet",
    "write_csv",
    "write_parquet",
]
