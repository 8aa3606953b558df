"""Readers: text lines, delimited, JSON, Parquet, partitioned folders, tables."""

from peneira.sources.delimited import read_csv, read_csv_with_preamble, split_fields
from peneira.sources.lines import read_lines
from peneira.sources.structured import (
    inline_rows,
    read_json,
    read_parquet,
    read_partition,
    spread,
)

__all__ = [
    "inline_rows",
    "read_csv",
    "read_csv_with_preamble",
    "read_json",
    "read_lines",
    "read_parquet",
    "read_partition",
    "split_fields",
    "spread",
]
