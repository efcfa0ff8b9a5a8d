"""Readers."""

from gristmill.sources.readers import (
    CORRUPT,
    READERS,
    read_any,
    read_delimited,
    read_jsonl,
    read_parquet,
    read_variants,
    split_corrupt,
    store_split,
    mark_corrupt,
    spread,
)

__all__ = [
    "CORRUPT",
    "READERS",
    "read_any",
    "read_delimited",
    "read_jsonl",
    "read_parquet",
    "read_variants",
    "split_corrupt",
    "store_split",
    "mark_corrupt",
    "spread",
]
