"""Intermediate tables on storage that every executor can reach."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

CONF = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def base(spark: SparkSession) -> str:
    """The shared folder the cluster names, else the home folder of a shared default file system.

    A folder of one machine is never chosen: other executors would not see its files.
    """
    named = spark.conf.get(CONF, None)
    if named:
        return named.rstrip("/")
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    if hadoop.get("fs.defaultFS", "file:///").startswith("file:"):
        raise ValueError(f"set {CONF} to a folder that the driver and all executors share")
    home = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.get(hadoop).getHomeDirectory()
    return home.toString().rstrip("/")


def folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{base(spark)}/gristmill-{label}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for the jobs in here; then it is what it was."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _shuffles_dropped(spark: SparkSession) -> AbstractContextManager[None]:
    """Jobs in here drop their shuffle files when they end, as nothing reads them after a write."""
    return setting(spark, CLEANUP, "true")


def materialize(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet and go on from the files.

    Cuts the lineage, so later jobs neither repeat the work nor see other rows
    after a lost executor, and they get column pruning and filter push-down. The
    shuffle files of the job are dropped with its end. ``path`` is for callers
    that release the table; else it is a new folder.
    """
    spark = df.sparkSession
    path = path or folder(spark, label)
    with _shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, label: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """As ``materialize``, dealt to files by ``key``: joins on it with rows that are dealt to as many
    partitions do not move this side.

    The catalog only passes the bucketing on; its entry is dropped, the files stay.
    """
    spark = df.sparkSession
    path = path or folder(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    with _shuffles_dropped(spark):
        dealt = df.repartition(buckets, key).write.bucketBy(buckets, key)
        dealt.format("parquet").option("path", path).option("compression", "zstd").saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out


def release(spark: SparkSession, *paths: str) -> None:
    """Delete tables of this run that no later job reads; only folders made by ``folder``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        if not path.startswith(f"{base(spark)}/gristmill-"):
            raise ValueError(f"{path} is not a folder of intermediate tables")
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
