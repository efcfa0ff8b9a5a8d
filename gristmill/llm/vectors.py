"""Vectors as rows of arrays: which rows count, and runs of neighbours in a sort order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there, has components, and none is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def runs_of(batch: pa.RecordBatch, group: tuple[int, ...], rows: int) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``rows`` neighbours of a sorted batch whose ``group`` columns are equal."""
    n = batch.num_rows
    fresh = np.zeros(n, bool)
    fresh[:1] = True
    for c in group:
        values = batch.column(c).to_numpy(zero_copy_only=False)
        fresh[1:] |= values[1:] != values[:-1]
    ends = np.append(np.flatnonzero(fresh), n).tolist()
    for a, b in zip(ends, ends[1:], strict=False):
        for low in range(a, b, rows):
            yield low, min(low + rows, b)


def matrix(column: pa.Array) -> np.ndarray:
    """Arrays of one length as the rows of a matrix, in the type of their components."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat).reshape(len(column), -1)
