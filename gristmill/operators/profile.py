"""One-pass table profiles, in long form: one output row per profiled column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions import quoted


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def _long(df: DataFrame, cols: Sequence[str], measures) -> DataFrame:
    """Aggregate ``measures(name)`` for every column in a single scan, then unpivot one row."""
    kinds = dict(df.dtypes)
    rows = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(name).alias("column"),
                F.lit(kinds[name]).alias("type"),
                *measures(F.col(quoted(name))),
            )
            for position, name in enumerate(cols)
        ]
    )
    return df.agg(rows.alias("_rows")).select(F.inline("_rows"))


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``position, column, type, count, mean, stddev, min, max`` of numeric columns.

    The deviation is the sample one. A NaN makes mean, stddev and max NaN.
    """

    def measures(col):
        value = col.cast("double")
        return [
            F.count(value).alias("count"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("stddev"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        ]

    return _long(df, cols or df.columns, measures)


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``position, column, type, nulls``."""
    return _long(
        df, cols or df.columns, lambda col: [F.count_if(col.isNull()).alias("nulls")]
    )


def overview(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Row count, nulls and summary of every column in one scan: one row per column, held locally.

    ``position, column, type, n_rows, nulls, count, mean, stddev, min, max``; the driver reads as
    many rows as there are columns.
    """

    def measures(col):
        value = col.cast("double")
        return [
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(col.isNull()).alias("nulls"),
            F.count(value).alias("count"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("stddev"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        ]

    found = _long(df, cols or df.columns, measures)
    return df.sparkSession.createDataFrame(found.collect(), found.schema)


def group_mean(df: DataFrame, key: str, value: str) -> DataFrame:
    """``key, n, avg`` in key order."""
    return (
        df.groupBy(F.col(quoted(key)))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(quoted(value)).alias("avg"))
        .orderBy(quoted(key))
    )


def head(df: DataFrame, n: int = 20, order_by: Sequence = ()) -> DataFrame:
    """First ``n`` rows; with an order this is a per-task top-n and a merge, not a sort."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
