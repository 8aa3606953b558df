"""Writers: text, delimited, JSON, Parquet, partitioned folders, tables, views."""

from peneira.sinks.files import write_csv, write_json, write_parquet, write_partitioned, write_text
from peneira.sinks.tables import TableSpec, bulk_load, register_view, save_table

__all__ = [
    "TableSpec",
    "bulk_load",
    "register_view",
    "save_table",
    "write_csv",
    "write_json",
    "write_parquet",
    "write_partitioned",
    "write_text",
]
