"""Data preparation, profiling and clustering operators for PySpark DataFrames."""

from gristmill import presets, scratch
from gristmill.operators import clean, cluster, columns, features, profile, sample, text

__all__ = [
    "clean",
    "cluster",
    "columns",
    "features",
    "presets",
    "profile",
    "sample",
    "scratch",
    "text",
]
