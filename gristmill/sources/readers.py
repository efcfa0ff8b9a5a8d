"""Delimited text, JSON lines and parquet, plus the quarantine of damaged text rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions import quoted

CORRUPT = "_corrupt_record"
DAMAGED = "_damaged"


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = "\t",
    header: bool = True,
    multiline: bool = False,
    infer: bool = False,
    schema: T.StructType | str | None = None,
    quote: str = '"',
    escape: str = '"',
    sampling: float | None = None,
    **options,
) -> DataFrame:
    """Delimited text, every column a string unless ``schema`` or ``infer`` says otherwise.

    Quotes inside quoted fields are doubled, empty fields are null, rows longer than the
    header are cut and shorter ones padded with nulls. Gzip is read transparently.
    ``multiline`` allows line breaks inside quoted fields. ``infer`` costs one more pass,
    over a ``sampling`` share of the rows if given.

    A gzip file, or any multi-line file, is one split: see ``spread``.
    """
    reader = (
        spark.read.option("header", header)
        .option("sep", sep)
        .option("multiLine", multiline)
        .option("inferSchema", infer and schema is None)
        .option("quote", quote)
        .option("escape", escape)
        .option("mode", "PERMISSIVE")
        .options(**options)
    )
    if sampling is not None:
        reader = reader.option("samplingRatio", sampling)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_jsonl(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    sampling: float | None = None,
    **options,
) -> DataFrame:
    """One JSON object per line. Without a schema one more pass infers the fields."""
    reader = spark.read.option("multiLine", False).options(**options)
    if sampling is not None:
        reader = reader.option("samplingRatio", sampling)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_variants(spark: SparkSession, path: str | list[str], column: str = "value") -> DataFrame:
    """One JSON value per line as a VARIANT, null where the line is none: no schema, so no pass to infer one.

    ``columns.variant_fields`` lifts fields, whatever type they have in which line.
    """
    return spark.read.text(path).select(F.try_parse_json("value").alias(column))


def read_parquet(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    paths = [path] if isinstance(path, str) else path
    return spark.read.options(**options).parquet(*paths)


READERS = {
    "tsv": read_delimited,
    "csv": lambda spark, path, **kw: read_delimited(spark, path, **{"sep": ",", **kw}),
    "jsonl": read_jsonl,
    "parquet": read_parquet,
}


def read_any(spark: SparkSession, path: str | list[str], format: str, **options) -> DataFrame:
    """Read with the reader of the named format: tsv, csv, jsonl or parquet."""
    if format not in READERS:
        raise ValueError(f"unknown format {format!r}; known: {sorted(READERS)}")
    return READERS[format](spark, path, **options)


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal the rows of an unsplittable scan (gzip, multi-line) to many tasks, by one shuffle.

    Without a number Spark chooses partitions of its advisory size, so a large input gets
    many. Only for inputs that are known to have too few splits.
    """
    return df.hint("rebalance") if partitions is None else df.repartition(partitions)


def mark_corrupt(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    corrupt: str = CORRUPT,
    **options,
) -> DataFrame:
    """Rows of delimited text with the raw row in column ``corrupt`` where it is damaged, else null.

    Rows with more or fewer fields than the header are damaged. The parser sees every field
    whatever is selected later, because column pruning is off for this scan, so nothing
    has to be cached for the damage to be noticed. Without a schema all columns are
    strings named by the header.
    """
    if schema is None:
        schema = read_delimited(spark, path, **options).schema
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    marked = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    rows = read_delimited(
        spark,
        path,
        schema=marked,
        **{**options, "columnNameOfCorruptRecord": corrupt, "columnPruning": False},
    )
    # Spark refuses a scan that needs nothing but the corrupt-record column; this
    # always-true test makes a bare count name a data column as well.
    return rows.where(F.length(F.concat_ws("", F.col(quoted(schema.names[0])).cast("string"))) >= 0)


def split_corrupt(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    corrupt: str = CORRUPT,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` rows of delimited text; ``bad`` also has the raw row.

    Each side is a scan of its own; to look at both in one, use ``mark_corrupt``, to keep both
    ``store_split``.
    """
    rows = mark_corrupt(spark, path, schema, corrupt, **options)
    is_bad = F.col(quoted(corrupt)).isNotNull()
    good = rows.where(~is_bad).select(*[F.col(quoted(n)) for n in rows.columns if n != corrupt])
    return good, rows.where(is_bad)


def store_split(
    spark: SparkSession,
    path: str | list[str],
    out: str,
    schema: T.StructType | str | None = None,
    corrupt: str = CORRUPT,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` like ``split_corrupt``, parsed once: both are read back from ``out``.

    One scan of the text writes parquet below ``out``, partitioned by whether a row is damaged;
    each side then reads its own folder only. ``out`` must not exist yet.
    """
    rows = mark_corrupt(spark, path, schema, corrupt, **options)
    rows.withColumn(DAMAGED, F.col(quoted(corrupt)).isNotNull()).write.partitionBy(DAMAGED).parquet(out)
    # The schema is given, as either side may have no file.
    stored = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField(DAMAGED, T.BooleanType())])).parquet(out)
    good = stored.where(~F.col(DAMAGED)).select(*[F.col(quoted(n)) for n in rows.columns if n != corrupt])
    return good, stored.where(F.col(DAMAGED)).drop(DAMAGED)
