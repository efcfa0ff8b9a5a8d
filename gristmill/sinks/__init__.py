"""Writers."""

from gristmill.sinks.writers import (
    best_model_path,
    write_clustered,
    write_delimited,
    write_jsonl,
    write_parquet,
    write_report,
    write_small_csv,
    z_order,
)

__all__ = [
    "best_model_path",
    "write_clustered",
    "write_delimited",
    "write_jsonl",
    "write_parquet",
    "write_report",
    "write_small_csv",
    "z_order",
]
