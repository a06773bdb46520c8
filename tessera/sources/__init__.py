"""Readers and writers for the inputs of the original jobs."""

from tessera.sources.text import read_text_rows, write_text_rows
from tessera.sources.csv import read_semicolon_csv, write_semicolon_csv
from tessera.sources.idx import read_idx, write_idx
from tessera.sources.inline import LABEL_NAMES, inline_table, label_name_table

__all__ = ["read_text_rows", "write_text_rows", "read_semicolon_csv",
           "write_semicolon_csv", "read_idx", "write_idx", "LABEL_NAMES", "inline_table",
           "label_name_table"]
