"""Scans: line-marked document files, headerless CSV (plain or bz2), tables."""

from quillspark.sources.csv import TAXI_FIELDS, read_csv_strings
from quillspark.sources.tables import TABLES, read_table
from quillspark.sources.text import (
    load_corpus,
    parse_id_text,
    parse_labelled,
    read_lines,
)

__all__ = [
    "TAXI_FIELDS",
    "TABLES",
    "load_corpus",
    "parse_id_text",
    "parse_labelled",
    "read_csv_strings",
    "read_lines",
    "read_table",
]
