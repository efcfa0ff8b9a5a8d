"""Equal points as one weighted row, and packed points."""

import pytest
from pyspark.sql import functions as F

from gristmill import scratch
from gristmill.operators import cluster, lloyd

CENTERS = {2: [(0.0, 0.0), (4.0, 3.0)], 4: [(0.0, 1.0), (4.0, 4.0), (6.0, 1.0), (1e6, 1e6)]}


@pytest.fixture(scope="module")
def weighted(spark):
    """70 different points that stand for one to five rows, and one without all of its parts."""
    rows = [(i % 10 * 0.7, i // 10 * 1.1, i % 5 + 1) for i in range(70)] + [(1.0, None, 9)]
    return scratch.materialize(spark.createDataFrame(rows, "x double, y double, n long").repartition(3), "weighted")


@pytest.fixture(scope="module")
def single(weighted):
    return scratch.materialize(weighted.select("x", "y", F.explode(F.sequence(F.lit(1), "n")).alias("i")).drop("i"), "single")


def told(rows):
    return {(r["k"], r["c"]): [r["n"], *(pytest.approx(v, rel=1e-12) for v in tuple(r)[3:])] for r in rows.collect()}


@pytest.mark.parametrize("packed", [False, True])
def test_weights_count_as_that_many_rows(weighted, single, packed):
    cols = ["x", "y"]
    rows, weight = (lloyd.blocks(weighted, cols, "n"), None) if packed else (weighted, "n")
    got = {(r["k"], r["c"]): list(tuple(r)[2:]) for r in lloyd.step(rows, cols, CENTERS, weight).collect()}
    assert got == told(lloyd.step(single, cols, CENTERS))
    want = lloyd.silhouettes(single, cols, CENTERS)
    assert lloyd.silhouettes(rows, cols, CENTERS, weight) == pytest.approx(want, abs=1e-12)
    for k, at in CENTERS.items():
        alone = cluster.silhouette(cluster.assign(weighted, cols, at), cols, k, weight="n").first()[0]
        assert alone == pytest.approx(want[k], abs=1e-12)
    seeds = lloyd.seeds(single, cols, [2, 5])
    held = rows if packed else None
    assert lloyd.seeds(weighted, cols, [2, 5], weight="n", packed=held) == seeds


def test_training_keeps_equal_rows_once(spark):
    rows = spark.range(4000).select((F.col("id") % 9).cast("double").alias("x"), (F.col("id") % 4 * 5).cast("double").alias("y"))
    trained = cluster.train(rows, ["x", "y"], ks=[2, 4], max_iter=10, partitions=3)
    assert trained.points.count() == 36
    assert trained.points.agg(F.sum(cluster.WEIGHT)).first()[0] == 4000
    assert all(sum(fit.sizes) == 4000 for fit in trained.sweep.fits.by_k.values())
    made = cluster.train(rows, ["x", "y"], ks=[2, 4], max_iter=10, score_fraction=0.5)
    for k, score in made.sweep.silhouettes.items():
        assert score == pytest.approx(trained.sweep.silhouettes[k], abs=0.05)


def test_keyed_rows_stay_apart(spark):
    rows = spark.range(300).select("id", (F.col("id") % 3).cast("double").alias("x"))
    trained = cluster.train(rows, ["x"], ks=[2], max_iter=5, key=["id"])
    assert trained.points.count() == 300


def test_thinned_weights_are_a_sample_of_the_rows(spark):
    rows = spark.range(0, 500, 1, 4).select(F.col("id").cast("double").alias("x"), F.lit(100).alias("n"))
    packed = scratch.materialize(lloyd.blocks(rows, ["x"], "n"), "packed")
    drawn = lloyd.thinned(packed, 0.2)
    counts = [lloyd.step(drawn, ["x"], {1: [(0.0,)]}).first()["n"] for _ in range(2)]
    assert counts[0] == counts[1]
    assert abs(counts[0] - 10_000) < 600


def test_heavy_rows_need_no_more_rounds(spark, monkeypatch):
    """What a row stands for does not thin the draws of further rounds."""
    rows = spark.range(0, 400, 1, 3).select(F.col("id").cast("double").alias("x"), F.lit(100_000).alias("n"))
    rounds, total = [], lloyd._total
    monkeypatch.setattr(lloyd, "_total", lambda *a, **named: rounds.append(1) or total(*a, **named))
    found = lloyd.seeds(rows, ["x"], [8], weight="n")
    assert len(set(found[8])) == 8
    assert len(rounds) <= 6


def test_a_refit_takes_equal_rows_once(spark):
    rows = spark.range(3000).select((F.col("id") % 5 * F.col("id") % 5).cast("double").alias("x"), (F.col("id") % 2 * 9).cast("double").alias("y"))
    trained = cluster.train(rows, ["x", "y"], ks=[2], max_iter=10, refit=True, partitions=2)
    last = cluster.kmeans_stage(trained.model)
    assert last.summary.predictions.count() == trained.points.count() < 20
    # Each centre is the mean of all rows of its cluster.
    at = {r["prediction"]: r for r in trained.model.transform(rows).groupBy("prediction").agg(F.avg("y").alias("y"), F.count("*").alias("n")).collect()}
    assert sum(r["n"] for r in at.values()) == 3000
    mean, spread = trained.model.stages[-2].mean[1], trained.model.stages[-2].std[1]
    for c, center in enumerate(last.clusterCenters()):
        assert center[1] == pytest.approx((at[c]["y"] - mean) / spread, abs=1e-9)
