"""Parsing and row filters for dirty numeric columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions import parse_number, quoted
from gristmill.functions.numbers import LENIENT_PATTERN

Bounds = Mapping[str, tuple[float, float]]


def parse_columns(
    df: DataFrame, cols: Sequence[str], mode: str = "strict", pattern: str = LENIENT_PATTERN
) -> DataFrame:
    """Replace text columns by their numbers, in one projection."""
    wanted = set(cols)
    return df.select(
        *[
            parse_number(F.col(quoted(c)), mode, pattern).alias(c)
            if c in wanted
            else F.col(quoted(c))
            for c in df.columns
        ]
    )


def in_bounds(bounds: Bounds, nulls: str = "reject") -> Column:
    """One predicate for ``lo <= column <= hi`` over every bounded column.

    ``nulls="keep"`` lets a missing value pass. NaN sorts above every number, so it
    never passes.
    """
    if nulls not in ("reject", "keep"):
        raise ValueError(f"nulls must be 'reject' or 'keep', not {nulls!r}")
    if not bounds:
        return F.lit(True)
    tests = []
    for name, (lo, hi) in bounds.items():
        col = F.col(quoted(name))
        inside = col.between(F.lit(float(lo)), F.lit(float(hi)))
        tests.append(inside if nulls == "reject" else col.isNull() | inside)
    return reduce(and_, tests)


def filter_bounds(df: DataFrame, bounds: Bounds, nulls: str = "reject") -> DataFrame:
    """Keep the plausible rows; a bound for a column that the table lacks is an error."""
    absent = [c for c in bounds if c not in df.columns]
    if absent:
        raise ValueError(f"bounds for columns that are not there: {absent}")
    return df.where(in_bounds(bounds, nulls))


def _known(df: DataFrame, name: str) -> Column:
    col = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, T.DoubleType | T.FloatType):
        return col.isNotNull() & ~F.isnan(col)
    return col.isNotNull()


def drop_all_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows in which every listed column is null or NaN."""
    return df.where(reduce(or_, [_known(df, c) for c in cols]))


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows in which any listed column is null or NaN.

    Same rows as ``dropna(how="any")``, in a form whose null tests reach the scan.
    """
    return df.where(reduce(and_, [_known(df, c) for c in cols]))
