import pytest
from conftest import as_set, plan_of
from pyspark.sql import functions as F

from gristmill.operators import clean, columns

NAN = float("nan")
SYN = {"fat": ["total-fat", "fat_100g"], "salt": ["salt_100g"], "iron": ["iron"]}


def test_resolve_first_spelling_wins_and_keeps_case():
    found = columns.resolve(["Fat_100G", "TOTAL-FAT", "x", "Salt_100g"], SYN)
    assert found == {"fat": "TOTAL-FAT", "salt": "Salt_100g"}


def test_resolve_required():
    assert columns.resolve(["x"], SYN) == {}
    with pytest.raises(ValueError):
        columns.resolve(["x"], SYN, required=True)
    with pytest.raises(ValueError, match="iron"):
        columns.resolve(["fat_100g"], SYN, required=["fat", "iron"])


def test_select_resolved(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0)], ["code", "total-fat", "Salt_100g"])
    got = columns.select_resolved(df, columns.resolve(df, SYN), keep=["code", "brand"])
    assert got.columns == ["code", "fat", "salt"]
    assert got.first() == ("a", 1.0, 2.0)


def test_select_present_order_and_guard(spark):
    df = spark.createDataFrame([(1, 2)], ["b", "a"])
    assert columns.select_present(df, ["a", "z", "b"]).columns == ["a", "b"]
    with pytest.raises(ValueError):
        columns.select_present(df, ["z"], required=True)
    with pytest.raises(ValueError):
        columns.require(df, ["a", "z"])


def test_flatten_struct(spark):
    df = spark.createDataFrame(
        [(1, (1.5, 2.5)), (2, (None, 3.5)), (3, None)],
        "id int, n struct<`energy_kcal`: double, `saturated-fat`: double>",
    )
    names = ["energy-kcal", "saturated-fat", "salt"]
    flat = columns.flatten_struct(df, "n", names)
    assert as_set(flat.drop("n")) == {(1, 1.5, 2.5, None), (2, None, 3.5, None), (3, None, None, None)}
    assert columns.flatten_struct(df, "n", names, missing="omit").columns == [
        "id", "n", "energy-kcal", "saturated-fat",
    ]
    assert columns.flatten_struct(df, "other", names) is df
    with pytest.raises(ValueError):
        columns.flatten_struct(df, "id", names)


@pytest.fixture(scope="module")
def edges(spark):
    rows = [("below", -0.1), ("low", 0.0), ("mid", 5.0), ("high", 10.0), ("above", 10.1),
            ("null", None), ("nan", NAN)]
    return spark.createDataFrame(rows, "name string, v double")


def test_bounds(edges):
    strict = clean.filter_bounds(edges, {"v": (0, 10)})
    with pytest.raises(ValueError, match="absent"):
        clean.filter_bounds(edges, {"v": (0, 10), "absent": (0, 1)})
    assert {r["name"] for r in strict.collect()} == {"low", "mid", "high"}
    kept = clean.filter_bounds(edges, {"v": (0, 10)}, nulls="keep")
    assert {r["name"] for r in kept.collect()} == {"low", "mid", "high", "null"}
    assert clean.filter_bounds(edges, {}).count() == 7
    with pytest.raises(ValueError):
        clean.in_bounds({"v": (0, 1)}, nulls="maybe")


def test_nan_comparison(spark):
    df = spark.createDataFrame([(NAN,), (1.0,), (None,)], "v double")
    assert [r[0] for r in df.select(F.col("v") <= 100).collect()] == [False, True, None]


def test_null_rows_match_dropna(spark):
    df = spark.createDataFrame(
        [(1, None, None), (2, 1.0, None), (3, NAN, None), (4, NAN, 2.0), (5, 1.0, 2.0)],
        "id int, a double, b double",
    )
    cols = ["a", "b"]
    assert as_set(clean.drop_all_null(df, cols).select("id")) == {(2,), (4,), (5,)}
    assert as_set(clean.complete_cases(df, cols).select("id")) == {(5,)}
    for how, mine in (("all", clean.drop_all_null), ("any", clean.complete_cases)):
        assert as_set(mine(df, cols).select("id")) == as_set(df.dropna(how, subset=cols).select("id"))


def test_filters_reach_the_scan(spark, data):
    items = spark.read.parquet(f"{data}/lineitem.parquet").select("l_orderkey", "l_tax")
    plan = plan_of(clean.filter_bounds(items, {"l_tax": (0.02, 0.04)}))
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(l_tax,0.02)" in pushed
    assert "LessThanOrEqual(l_tax,0.04)" in pushed
    assert "l_quantity" not in plan
    assert "IsNotNull(l_tax)" in plan_of(clean.complete_cases(items, ["l_tax"]))


def test_parse_columns_keeps_the_rest(spark):
    df = spark.createDataFrame([("x", "1,5", "2 g")], ["id", "energy-kj", "b.c"])
    got = clean.parse_columns(df, ["energy-kj", "b.c"], mode="lenient")
    assert got.columns == df.columns
    assert tuple(got.first()) == ("x", 1.5, 2.0)
