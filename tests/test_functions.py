import pytest
from pyspark.sql import functions as F

from gristmill.functions import key_rank, nearest, parse_number, quoted, squared_distance

INF = float("inf")
# text, strict, lenient
GOLDEN = [
    ("1.5", 1.5, 1.5),
    ("1,5", 1.5, 1.5),
    ("1,234.5", None, 1.234),
    ("1.2.3", None, 1.2),
    (" 1.5 ", 1.5, 1.5),
    ("1e3", 1000.0, 1.0),
    ("NaN", "nan", None),
    ("Infinity", INF, None),
    ("abc", None, None),
    ("", None, None),
    (".5", 0.5, 5.0),
    ("<0.5", None, 0.5),
    ("-3", -3.0, -3.0),
    ("5 g", None, 5.0),
    ("- 7", None, 7.0),
    ("1.5d", 1.5, 1.5),
    (None, None, None),
]


def test_parse_number_golden(spark):
    df = spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDEN)], "i int, t string")
    got = df.select(
        "i", parse_number("t").alias("s"), parse_number("t", "lenient").alias("l")
    ).orderBy("i")
    for row, (text, strict, lenient) in zip(got.collect(), GOLDEN, strict=True):
        found = "nan" if row["s"] is not None and row["s"] != row["s"] else row["s"]
        assert found == strict, text
        assert row["l"] == lenient, text


def test_parse_number_takes_numbers_and_patterns(spark):
    df = spark.createDataFrame([(7, "x12.5kg")], "n int, t string")
    row = df.select(
        parse_number("n").alias("n"),
        parse_number("t", "lenient", r"(\d+)").alias("t"),
    ).first()
    assert (row["n"], row["t"]) == (7.0, 12.0)
    with pytest.raises(ValueError):
        parse_number("t", "loose")


def test_nearest_ties_and_nulls(spark):
    rows = [(0.0, 0.0), (1.0, 1.0), (0.5, 0.5), (None, 1.0), (float("nan"), 0.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    points = [(0.0, 0.0), (1.0, 1.0)]
    d = F.array(*[squared_distance(["x", "y"], p) for p in points])
    got = [r["c"] for r in df.withColumn("d", d).select(nearest("d").alias("c")).collect()]
    assert got == [0, 1, 0, None, None]


def test_squared_distance_checks_width():
    with pytest.raises(ValueError):
        squared_distance(["x", "y"], [1.0])


def test_key_rank_ignores_partitioning(spark):
    df = spark.range(2000).withColumn("k", F.concat(F.lit("key"), F.col("id")))
    once = {tuple(r) for r in df.select("k", key_rank("k")).collect()}
    again = {tuple(r) for r in df.repartition(5).select("k", key_rank("k")).collect()}
    assert once == again
    ranks = [r for _, r in once]
    assert 0 <= min(ranks) and max(ranks) < 2**32
    assert abs(sum(ranks) / len(ranks) / 2**31 - 1) < 0.1


def test_quoted_names(spark):
    name = "energy-kcal.100`g"
    df = spark.createDataFrame([(1,)], [name])
    assert df.select(F.col(quoted(name))).first()[0] == 1
