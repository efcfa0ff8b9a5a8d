import os

import pytest
from pyspark.sql import functions as F

from gristmill import scratch


def test_bucketed_side_is_not_shuffled(spark):
    rows = spark.range(1000).withColumn("x", F.col("id") * 2)
    held = scratch.bucketed(rows, "held", "id", 5)
    back = scratch.bucketed(rows.where("id % 3 = 0").select("id", F.col("x").alias("y")), "back", "id", 5)
    both = held.join(back.hint("shuffle_hash"), "id", "left")
    assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
    assert both.count() == 1000 and both.where("x = y").count() == 334
    assert not any("gristmill" in t.name for t in spark.catalog.listTables())


def test_release_deletes_only_own_tables(spark, tmp_path):
    path = scratch.folder(spark, "gone")
    assert scratch.materialize(spark.range(10), "gone", path).count() == 10
    scratch.release(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))
    with pytest.raises(ValueError, match="intermediate"):
        scratch.release(spark, str(tmp_path))
    assert tmp_path.exists()


def test_cleanup_setting_is_put_back(spark):
    before = spark.conf.get(scratch.CLEANUP, "false")
    scratch.materialize(spark.range(10).repartition(3, "id"), "kept")
    assert spark.conf.get(scratch.CLEANUP, "false") == before
