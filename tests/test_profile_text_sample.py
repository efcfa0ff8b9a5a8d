import math

import pytest
from conftest import as_set, plan_of
from pyspark.sql import functions as F

from gristmill.functions import key_rank
from gristmill.operators import profile, sample, text


def counts(spark, lines, sep):
    df = spark.createDataFrame([(s,) for s in lines], "line string")
    return {r["word"]: r["n"] for r in text.word_count(df, "line", sep).collect()}


def test_word_count_golden(spark):
    a = ["hello world", "hello spark", "big data spark"]
    assert counts(spark, a, " ") == {"hello": 2, "spark": 2, "world": 1, "big": 1, "data": 1}
    b = ["hello spark", "hello big data", "spark makes clusters"]
    want = {"hello": 2, "spark": 2, "big": 1, "data": 1, "makes": 1, "clusters": 1}
    assert counts(spark, b, None) == want


def test_word_count_empty_tokens(spark):
    assert counts(spark, ["a  b"], " ") == {"a": 1, "b": 1, "": 1}
    assert counts(spark, ["a  b"], None) == {"a": 1, "b": 1}
    assert counts(spark, ["", None, " x"], " ") == {"": 2, "x": 1}
    assert counts(spark, ["a.b.c"], ".") == {"a": 1, "b": 1, "c": 1}


def test_word_count_splits_like_python(spark):
    lines = ["a b　c\x1cd\te\x0bf\r\ng h", " lead trail ", "\x85x", "y​z"]
    want = {}
    for line in lines:
        for word in line.split():
            want[word] = want.get(word, 0) + 1
    assert counts(spark, lines, None) == want


def test_word_count_aggregates_before_the_shuffle(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    plan = plan_of(text.word_count(docs, "text"))
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1


def test_group_mean_golden(spark):
    df = spark.createDataFrame([("A", 10), ("A", 20), ("B", 30), ("B", 50)], ["group", "value"])
    got = profile.group_mean(df, "group", "value").collect()
    assert [tuple(r) for r in got] == [("A", 2, 15.0), ("B", 2, 40.0)]


def test_describe_and_null_counts(spark):
    df = spark.createDataFrame(
        [(1.0, 4, "x"), (3.0, None, None), (None, None, "z")], "a double, b int, c string"
    )
    got = {r["column"]: r for r in profile.describe(df, ["a", "b"]).collect()}
    a, b = got["a"], got["b"]
    assert (a["position"], a["type"], a["count"], a["mean"], a["min"], a["max"]) == (
        0, "double", 2, 2.0, 1.0, 3.0,
    )
    assert a["stddev"] == pytest.approx(math.sqrt(2))
    assert (b["count"], b["mean"], b["stddev"]) == (1, 4.0, None)
    nulls = profile.null_counts(df)
    assert as_set(nulls.select("position", "column", "nulls")) == {
        (0, "a", 1), (1, "b", 2), (2, "c", 1),
    }
    assert plan_of(nulls).count("Exchange") == 1
    assert profile.row_count(df).first()["n_rows"] == 3


def test_describe_propagates_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "a double")
    row = profile.describe(df).first()
    assert math.isnan(row["mean"]) and math.isnan(row["max"]) and row["min"] == 1.0


def test_head_is_a_bounded_merge(spark, data):
    orders = spark.read.parquet(f"{data}/orders.parquet")
    top = profile.head(orders, 5, [F.desc("o_totalprice")])
    assert "TakeOrderedAndProject" in plan_of(top)
    values = [r["o_totalprice"] for r in top.collect()]
    assert values == sorted(values, reverse=True) and len(values) == 5
    assert profile.head(orders, 7).count() == 7


# ---- samples ---------------------------------------------------------------


def test_bernoulli_target(spark):
    df = spark.range(10_000)
    n = sample.to_target(df, 1_000).count()
    assert abs(n - 1_000) < 5 * math.sqrt(900)
    assert sample.to_target(df, 20_000).count() == 10_000
    assert sample.to_target(spark.range(0), 5).count() == 0
    assert as_set(sample.to_target(df, 1_000)) == as_set(sample.to_target(df, 1_000))
    assert as_set(sample.to_target(df, 1_000)) != as_set(sample.to_target(df, 1_000, seed=1))


def test_cap_is_hard_and_spares_small_tables(spark):
    df = spark.range(50_000)
    for seed in (1, 2, 3):
        assert sample.to_target(df, 2_000, seed=seed, cap=True).count() <= 2_000
    assert sample.to_target(df, 50_000, cap=True) is df


def test_fraction(spark):
    n = sample.fraction(spark.range(20_000), 0.15).count()
    assert abs(n - 3_000) < 5 * math.sqrt(20_000 * 0.15 * 0.85)


def test_keyed_is_stable(spark):
    df = spark.range(5_000).withColumn("v", F.col("id") % 7)
    for cap in (False, True):
        once = as_set(sample.to_target(df, 500, key="id", cap=cap))
        again = as_set(sample.to_target(df.repartition(13), 500, key="id", cap=cap))
        assert once == again
        assert (len(once) == 500) if cap else abs(len(once) - 500) < 120
    assert "Exchange" not in plan_of(sample.keyed(df, "id", 100, 1000))


def test_keyed_takes_whole_keys(spark):
    df = spark.range(3_000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    taken = sample.keyed(df, "k", 500, 1000)
    hot = taken.where("k = 0").count()
    assert hot in (0, 1_000)


def test_exact_cap_with_a_hot_key(spark):
    df = spark.range(3_000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    for n in (1, 100, 999, 1_000, 2_999):
        assert sample.to_target(df, n, key="k", cap=True).count() == n


def test_hot_rank_is_split_by_the_next(spark):
    hot = F.when(F.col("id") % 2 == 0, 500).otherwise(F.col("id"))
    df = spark.range(1_000).select(hot.alias("r"), ((F.col("id") * 7919) % 1_000).alias("s"))
    rows = sorted((500 if i % 2 == 0 else i, (i * 7919) % 1_000) for i in range(1_000))
    for n in (250, 300, 700, 751):
        got = sample.lowest_ranks(df, ["r", "s"], n)
        assert sorted(tuple(r) for r in got.collect()) == rows[:n]


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 999, 1_000, 2_000])
def test_lowest_ranks(spark, n):
    spread_out = (F.col("id") * 2_654_435_761) % (1 << 32)
    df = spark.range(1_000).withColumn("r", spread_out)
    want = sorted((i * 2_654_435_761) % (1 << 32) for i in range(1_000))[:n]
    got = sorted(r["r"] for r in sample.lowest_ranks(df, ["r"], n).collect())
    assert got == want


def test_lowest_ranks_with_equal_ranks(spark):
    df = spark.range(100).withColumn("r", F.lit(5))
    assert sample.lowest_ranks(df, ["r"], 10).count() == 10


def test_composite_keys_stay_apart(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "a"), ("a", None)], "x string, y string")
    ranks = [r[0] for r in df.select(key_rank(["x", "y"])).collect()]
    assert len(set(ranks)) == 4


def test_cap_with_awkward_columns(spark):
    df = spark.range(50).select(F.lit(1).alias("k.1"), F.create_map(F.lit("m"), "id").alias("m"))
    assert sample.to_target(df, 20, cap=True, key="k.1").count() == 20


def test_group_mean_of_quoted_names(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0)], "`a.b` int, `c.d` double")
    assert [tuple(r) for r in profile.group_mean(df, "a.b", "c.d").collect()] == [(1, 2, 3.0)]
