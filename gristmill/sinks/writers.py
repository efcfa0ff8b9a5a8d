"""Parquet, text and report sinks. Every writer returns the path it wrote."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import quoted

Z, Z_BITS = "_z", 10


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> str:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return path


def z_order(bounds: Mapping[str, tuple[float, float]], bits: int = Z_BITS) -> Column:
    """The bits of all columns in turn, highest first: rows near in every column have near numbers.

    Each column is cut to ``2^bits`` equal steps between its bounds; values beyond them belong to
    the first or last step, null and NaN to the first. ``bits`` times the number of columns is 62
    at most.
    """
    if not bounds or bits * len(bounds) > 62:
        raise ValueError("the bits of all columns have to fit a long")
    number = F.lit(0).cast("bigint")
    for place, (name, (low, high)) in enumerate(bounds.items()):
        value = F.col(quoted(name)).cast("double")
        share = (value - F.lit(float(low))) / F.lit(float(high) - float(low) or 1.0)
        share = F.when(~F.isnan(share), share)
        cell = F.least(F.greatest(F.coalesce(share, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)) * ((1 << bits) - 1)
        cell = F.floor(cell).cast("bigint")
        for bit in range(bits):
            to = bit * len(bounds) + len(bounds) - 1 - place
            number = number.bitwiseOR(F.shiftleft(F.shiftright(cell, bit).bitwiseAND(F.lit(1).cast("bigint")), to))
    return number


def write_clustered(
    df: DataFrame, path: str, bounds: Mapping[str, tuple[float, float]], files: int | None = None, mode: str = "overwrite"
) -> str:
    """Parquet whose files and row groups hold neighbours in the columns of ``bounds``.

    Rows are dealt by ranges of their ``z_order`` and sorted by it, so a filter on any of the
    columns skips most of a large table by the statistics that parquet keeps. One shuffle;
    without ``files`` Spark chooses files of its advisory size.
    """
    placed = df.withColumn(Z, z_order(bounds))
    placed = placed.repartitionByRange(Z) if files is None else placed.repartitionByRange(files, Z)
    placed.sortWithinPartitions(Z).drop(Z).write.mode(mode).parquet(path)
    return path


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = "\t",
    mode: str = "overwrite",
    compression: str = "none",
    **options,
) -> str:
    """Delimited text that ``read_delimited`` reads back unchanged, blanks included."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", compression)
        .options(**options)
        .csv(path)
    )
    return path


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", **options) -> str:
    df.write.mode(mode).options(**options).json(path)
    return path


def write_small_csv(df: DataFrame, path: str) -> str:
    """A result as exactly one CSV part with a header.

    Only the finished rows move to the one task; the work above them stays distributed.
    Meant for results bounded by construction, such as k centres or one row per brand;
    anything that grows with the data belongs in ``write_delimited``.
    """
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_report(
    scores: DataFrame,
    path: str,
    model_paths: Mapping[int, str] | None = None,
) -> str:
    """The training report: one JSON document with the best k and the whole sweep.

    ``scores`` has ``k, silhouette, is_best``. The document is
    ``{"best": {"k", "silhouette", "model_path"}, "sweep": [...]}``.
    """
    path_of = F.lit(None).cast("string")
    for k, where in (model_paths or {}).items():
        path_of = F.when(F.col("k") == k, F.lit(where)).otherwise(path_of)
    rows = scores.withColumn("model_path", path_of)
    report = rows.agg(
        F.max(
            F.when(F.col("is_best"), F.struct("k", "silhouette", "model_path"))
        ).alias("best"),
        # One entry per k tried.
        F.array_sort(
            F.collect_list(F.struct("k", "silhouette", "is_best", "model_path"))
        ).alias("sweep"),
    )
    report.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def best_model_path(spark: SparkSession, report: str) -> str:
    """Where the report says the best model is."""
    found = spark.read.schema("best struct<model_path: string>").json(report).first()
    if found is None or found["best"] is None or found["best"]["model_path"] is None:
        raise ValueError(f"{report} names no model")
    return found["best"]["model_path"]
