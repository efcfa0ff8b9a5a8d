"""Profiles as stored state: one table per slice, merged without a look at the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions import quoted

_MEASURES = ("n_rows", "nulls", "count", "mean", "m2", "min", "max")


def profile_state(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by.., position, column, type, n_rows, nulls, count, mean, m2, min, max``, in one scan.

    ``m2`` is the sum of squared deviations from the mean. Store the table with the slices named
    by ``by``; a new slice costs only its own scan.
    """
    kinds, groups = dict(df.dtypes), [F.col(quoted(c)) for c in by]
    rows = []
    for position, name in enumerate(cols):
        value = F.col(quoted(name)).cast("double")
        rows.append(
            F.struct(
                F.lit(position).alias("position"),
                F.lit(name).alias("column"),
                F.lit(kinds[name]).alias("type"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(F.col(quoted(name)).isNull()).alias("nulls"),
                F.count(value).alias("count"),
                F.avg(value).alias("mean"),
                (F.var_pop(value) * F.count(value)).alias("m2"),
                F.min(value).alias("min"),
                F.max(value).alias("max"),
            )
        )
    return df.groupBy(*groups).agg(F.array(*rows).alias("_rows")).select(*groups, F.inline("_rows"))


def merge_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The state of the union of all slices with the same ``by``; the columns are those of a state.

    Deviations are taken from the common mean before they are added up, so nothing cancels.
    Slices without values do not count; a NaN makes mean, m2 and max NaN, as in one scan.
    """
    keys = [*by, "position", "column", "type"]
    each = Window.partitionBy(*[quoted(c) for c in keys])
    part = F.when(F.col("count") > 0, F.col("count") * F.col("mean"))
    common = F.sum(part).over(each) / F.sum("count").over(each)
    gap = F.col("mean") - F.col("_common")
    moved = states.withColumn("_common", common).withColumn("_m2", F.when(F.col("count") > 0, F.col("m2") + F.col("count") * gap * gap))
    return moved.groupBy(*[quoted(c) for c in keys]).agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "nulls", "count")],
        F.max("_common").alias("mean"),
        F.sum("_m2").alias("m2"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
    )


def summary(states: DataFrame) -> DataFrame:
    """The state as ``describe`` tells it, nulls and row counts too: ``m2`` becomes the sample deviation."""
    kept = [quoted(c) for c in states.columns if c not in _MEASURES]
    spread = F.when(F.col("count") > 1, F.sqrt(F.col("m2") / (F.col("count") - 1)))
    return states.select(*kept, "n_rows", "nulls", "count", "mean", spread.alias("stddev"), "min", "max")
