"""Typed sources and sinks (SRC-*, SNK-*)."""

from featmart.sources.tables import TABLES, read_table, tables
from featmart.sources.files import (
    read_csv, read_tsv, null_sentinels, snake_case_columns, read_labelled_files,
    write_csv, fill_template, format_fixed,
)

__all__ = [
    "TABLES", "read_table", "tables", "read_csv", "read_tsv", "null_sentinels",
    "snake_case_columns", "read_labelled_files", "write_csv", "fill_template", "format_fixed",
]
