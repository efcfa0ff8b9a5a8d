import math
import random
import statistics

import pytest
from conftest import as_set, plan_of
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from gristmill.operators import features

NAN = float("nan")
GAPPY = [(1.0, None), (2.0, 4.0), (None, 6.0), (10.0, 8.0), (None, None)]


@pytest.fixture(scope="module")
def gappy(spark):
    return spark.createDataFrame(GAPPY, "a double, b double").coalesce(1)


def median_of(spark, values, **kw):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return features.medians(df, ["v"], exact=True, **kw).first()["median"]


def test_impute_golden(gappy):
    want = {(1.0, 6.0), (2.0, 4.0), (2.0, 6.0), (10.0, 8.0)}
    assert as_set(features.impute(gappy, ["a", "b"], exact=True)) == want
    assert as_set(features.impute(gappy, ["a", "b"])) == want
    given = features.impute(gappy, ["a"], fill={"a": -1})
    assert [r["a"] for r in given.collect()] == [1.0, 2.0, -1.0, 10.0, -1.0]


def test_impute_needs_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    with pytest.raises(ValueError, match="a"):
        features.impute(df, ["a", "b"])


def test_scaler_golden(gappy):
    full = features.impute(gappy, ["a", "b"], exact=True)
    want = [(-0.6461, 0.0), (-0.3769, -1.4142), (-0.3769, 0.0), (1.7767, 1.4142), (-0.3769, 0.0)]
    got = [tuple(r) for r in features.standardize(full, ["a", "b"]).collect()]
    for g, w in zip(got, want, strict=True):
        assert g == pytest.approx(w, abs=1e-4)
    model = Pipeline(stages=features.stages(["a", "b"])).fit(gappy)
    made = model.transform(gappy).select(vector_to_array("features").alias("f")).collect()
    for g, w in zip(made, want, strict=True):
        assert g["f"] == pytest.approx(w, abs=1e-4)


def test_standardize_constant_null_and_prefix(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, None), (3, 5.0, 3.0)], "id int, k double, v double")
    got = features.standardize(df, ["k", "v"], prefix="z_").orderBy("id")
    assert got.columns == ["id", "k", "v", "z_k", "z_v"]
    r = math.sqrt(0.5)
    rows = [(x["z_k"], x["z_v"]) for x in got.collect()]
    assert rows == [(0.0, pytest.approx(-r)), (0.0, None), (0.0, pytest.approx(r))]
    one = spark.createDataFrame([(7.0,)], "v double")
    assert features.standardize(one, ["v"]).first()["v"] == 0.0
    empty = spark.createDataFrame([(None,)], "v double")
    assert features.standardize(empty, ["v"]).first()["v"] is None


def test_standardize_with_fitted_moments(spark):
    train = spark.createDataFrame([(1.0,), (3.0,)], "v double")
    other = spark.createDataFrame([(5.0,)], "v double")
    fitted = features.moments(train, ["v"])
    got = features.standardize(other, ["v"], fitted=fitted).first()["v"]
    assert got == pytest.approx(3 / math.sqrt(2))


def test_standardize_joins_nothing(spark, data):
    items = spark.read.parquet(f"{data}/lineitem.parquet")
    plan = plan_of(features.standardize(items, ["l_tax"]).select("l_tax"))
    assert "Join" not in plan and "Exchange" not in plan and "ReadSchema: struct<l_tax:double>" in plan


@pytest.mark.parametrize(
    "values",
    [
        [1.0],
        [1.0, 2.0],
        [3.0, 1.0, 2.0],
        [5.0] * 7,
        [None, NAN, 4.0, None, 2.0],
        [-0.5, 0.0, 1e300, -1e300],
    ],
)
def test_exact_median_small(spark, values):
    real = [v for v in values if v is not None and v == v]
    assert median_of(spark, values) == statistics.median(real)
    assert median_of(spark, values) == statistics.median(real)


def test_exact_median_of_nothing(spark):
    assert median_of(spark, [None, NAN]) is None


@pytest.mark.parametrize("shape", ["uniform", "heavy", "duplicates", "split", "two_values"])
def test_exact_median_narrowed(spark, shape):
    n = 2_000 + len(shape) % 2
    rng = random.Random(n)
    draw = {
        "uniform": lambda: rng.random(),
        "heavy": lambda: math.exp(rng.gauss(0, 30)) * rng.choice([-1, 1]),
        "duplicates": lambda: 7.0 if rng.random() < 0.4 else rng.random() * 20,
        "split": lambda: rng.choice([-1e6, 1e6]) + rng.random(),
        "two_values": lambda: float(rng.random() < 0.5),
    }[shape]
    values = [draw() for _ in range(n)]
    got = median_of(spark, values, window=40, sample=400)
    assert got == statistics.median(values)


def test_medians_of_several_columns(spark):
    rng = random.Random(5)
    rows = [(rng.random(), float(i % 5), None if i % 3 else rng.gauss(0, 1)) for i in range(900)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    want = {
        c: statistics.median([r[i] for r in rows if r[i] is not None])
        for i, c in enumerate("abc")
    }
    got = features.medians(df, list("abc"), exact=True, window=50, sample=100)
    assert {r["column"]: r["median"] for r in got.collect()} == want
    approx = {r["column"]: r["median"] for r in features.medians(df, list("abc")).collect()}
    for c in "abc":
        assert approx[c] == pytest.approx(want[c], abs=0.05)


def test_moments(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, None)], "a double, b double")
    got = {r["column"]: (r["mean"], r["stddev"]) for r in features.moments(df, ["a", "b"]).collect()}
    assert got == {"a": (2.0, pytest.approx(math.sqrt(2))), "b": (2.0, None)}


def test_assemble_skip_and_error(gappy):
    kept = features.assemble(gappy, ["a", "b"], invalid="skip")
    assert kept.count() == 2
    with pytest.raises(Exception, match="(?i)null"):
        features.assemble(gappy, ["a", "b"]).collect()


def test_bad_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None), (4, [])], "id int, v array<double>")
    vec = df.select(F.when(F.col("v").isNotNull(), array_to_vector("v")).alias("v"))
    assert features.bad_vectors(vec, "v", 2).first()["n_bad"] == 3


def test_sketches_of_slices_merge_to_the_union_in_any_order(spark):
    rows = spark.range(200_000).select(
        (F.col("id") % 11).alias("g"),
        (F.col("id") * 7919 % 200_003).cast("double").alias("a"),
        F.when(F.col("id") % 3 == 0, F.lit(math.nan)).otherwise(F.pow(F.rand(3), 4)).alias("b"),
        F.lit(None).cast("double").alias("none"),
    )
    slices = features.quantile_sketches(rows, ["a", "b", "none"], by=["g"]).cache()
    shares = [0.01, 0.25, 0.5, 0.99]
    for parts in (1, 3, 11):
        merged = features.merge_sketches(slices.repartition(parts, F.rand(parts)))
        for r in features.sketched_quantiles(merged, shares).collect():
            if r["column"] == "none":
                assert r["value"] is None
                continue
            known = rows.where(F.col(r["column"]).isNotNull() & ~F.isnan(r["column"]))
            n, below, upto = known.agg(F.count("*"), F.count_if(F.col(r["column"]) < r["value"]), F.count_if(F.col(r["column"]) <= r["value"])).first()
            assert below / n - features.RANK_ERROR <= r["share"] <= upto / n + features.RANK_ERROR
    assert [r["median"] for r in features.medians(rows.where("false"), ["a"]).collect()] == [None]
