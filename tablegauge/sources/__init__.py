"""Readers: delimited text with pandas-like typing, parquet tables, and result sinks."""

from tablegauge.sources.delimited import read_delimited, type_columns
from tablegauge.sources.tables import load_table

__all__ = ["load_table", "read_delimited", "type_columns"]
