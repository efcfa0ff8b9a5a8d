import random

import pytest
from conftest import as_set, plan_of
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from gristmill import sinks
from gristmill.operators import cluster, features

POINTS = [(0.0, 0.0), (10.0, 0.0), (0.0, 10.0)]


@pytest.fixture(scope="module")
def blobs(spark):
    rng = random.Random(3)
    rows = [
        (i, *(c + rng.gauss(0, 0.3) for c in POINTS[i % 3]), i % 3) for i in range(300)
    ]
    return spark.createDataFrame(rows, "id int, x double, y double, truth int").repartition(4).cache()


@pytest.fixture(scope="module")
def vectors(blobs):
    return VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(blobs)


@pytest.fixture(scope="module")
def trained(blobs):
    return cluster.train(blobs, ["x", "y"], ks=range(2, 6), max_iter=20, partitions=4)


def test_assign_to_given_centres(spark, blobs):
    got = cluster.assign(blobs, ["x", "y"], POINTS)
    assert got.where("cluster <> truth").count() == 0
    assert "Exchange" not in plan_of(cluster.assign(spark.range(5).toDF("x"), ["x"], [(1.0,), (3.0,)]))
    tie = spark.createDataFrame([(0.5,), (None,)], "x double")
    assert [r["c"] for r in cluster.assign(tie, ["x"], [(0.0,), (1.0,)], "c").collect()] == [0, None]


def test_lloyd_step_by_hand(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (4.0,), (9.0,)], "x double")
    got = sorted(tuple(r) for r in cluster.lloyd_step(df, ["x"], [(0.0,), (8.0,)]).collect())
    assert got == [(0, 3, pytest.approx(5 / 3)), (1, 1, 9.0)]


def test_reports(blobs):
    labelled = blobs.withColumn("cluster", F.col("truth"))
    assert [tuple(r) for r in cluster.sizes(labelled).collect()] == [(0, 100), (1, 100), (2, 100)]
    profile = {r["cluster"]: r for r in cluster.profile(labelled, ["x", "y"]).collect()}
    assert profile[1]["n"] == 100 and profile[1]["avg_x"] == pytest.approx(10, abs=0.2)
    got = cluster.examples(labelled, ["id"], n=2)
    assert as_set(got) == {(0, 0, 1), (0, 3, 2), (1, 1, 1), (1, 4, 2), (2, 2, 1), (2, 5, 2)}
    plan = plan_of(cluster.examples(labelled, ["id"], n=2))
    # One limit inside the tasks, below the exchange, and one above it.
    limits = plan.index("WindowGroupLimit"), plan.rindex("WindowGroupLimit")
    assert limits[0] < plan.index("Exchange") < limits[1]


def silhouette_by_hand(rows):
    def d(p, q):
        return sum((a - b) ** 2 for a, b in zip(p, q, strict=True))

    total = 0.0
    for i, (p, c) in enumerate(rows):
        same = [d(p, q) for j, (q, k) in enumerate(rows) if k == c and j != i]
        if not same:
            continue
        a = sum(same) / len(same)
        means = []
        for other in {k for _, k in rows} - {c}:
            far = [d(p, q) for q, k in rows if k == other]
            means.append(sum(far) / len(far))
        b = min(means)
        total += 0.0 if max(a, b) == 0 else (b - a) / max(a, b)
    return total / len(rows)


def test_silhouette_against_all_pairs_and_ml(spark):
    rng = random.Random(9)
    rows = [((rng.random(), rng.random()), rng.randrange(3)) for _ in range(60)]
    rows.append(((5.0, 5.0), 3))
    df = spark.createDataFrame([(*p, c) for p, c in rows], "x double, y double, prediction int")
    want = silhouette_by_hand(rows)
    mine = cluster.silhouette(df, ["x", "y"], 4, "prediction").first()["silhouette"]
    # An empty cluster number changes nothing.
    more = cluster.silhouette(df, ["x", "y"], 6, "prediction").first()["silhouette"]
    vec = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df)
    assert mine == pytest.approx(want, abs=1e-12)
    assert more == pytest.approx(want, abs=1e-12)
    assert cluster.evaluate(vec) == pytest.approx(want, abs=1e-12)


def test_silhouette_edges(spark):
    schema = "x double, cluster int"
    lone = spark.createDataFrame([(0.0, 0), (0.2, 0), (9.0, 1)], schema)
    want = silhouette_by_hand([((0.0,), 0), ((0.2,), 0), ((9.0,), 1)])
    assert cluster.silhouette(lone, ["x"], 2).first()[0] == pytest.approx(want)
    same = spark.createDataFrame([(1.0, 0), (1.0, 0), (1.0, 1), (1.0, 1)], schema)
    assert cluster.silhouette(same, ["x"], 2).first()[0] == 0.0
    single = spark.createDataFrame([(0.0, 0), (1.0, 0)], schema)
    assert cluster.silhouette(single, ["x"], 2).first()[0] is None
    with_null = spark.createDataFrame([(0.0, 0), (0.2, 0), (9.0, 1), (4.0, None)], schema)
    assert cluster.silhouette(with_null, ["x"], 2).first()[0] == pytest.approx(want)
    with pytest.raises(ValueError):
        cluster.silhouette(lone.withColumn("cluster", F.col("cluster") + 5), ["x"], 2)


def test_evaluate_needs_two_clusters(spark):
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.createDataFrame([(1.0, 0), (2.0, 0)], "x double, prediction int")
    )
    assert cluster.evaluate(df) is None


def test_best_k_rule(spark):
    scores = spark.createDataFrame([(3, 0.4), (4, 0.7), (5, 0.7), (6, None)], "k int, silhouette double")
    assert tuple(cluster.best_k(scores).first()) == (4, 0.7)


def test_sweep_finds_the_three_groups(trained):
    assert trained.sweep.best == 3
    assert trained.sweep.silhouettes[3] > 0.95
    rows = {r["k"]: r for r in trained.sweep.scores.collect()}
    assert set(rows) == {2, 3, 4, 5}
    assert [k for k, r in rows.items() if r["is_best"]] == [3]
    assert cluster.best_k(trained.sweep.scores).first()["k"] == 3
    assert all(-1 <= r["silhouette"] <= 1 for r in rows.values())


def test_sweep_sampled_and_serial_agree_on_k(blobs):
    fast = cluster.sweep(blobs, ["x", "y"], [2, 3, 4], max_iter=20, tol=1e-3, score_fraction=0.5)
    assert fast.best == 3


def test_sweep_scores_equal_the_evaluator(blobs, vectors):
    found = cluster.sweep(blobs, ["x", "y"], [2, 4], max_iter=20)
    for k, model in found.models.items():
        want = cluster.evaluate(model.transform(vectors))
        assert found.silhouettes[k] == pytest.approx(want, abs=1e-9)


def test_sweep_without_two_clusters(spark):
    same = spark.createDataFrame([(1.0,)] * 5, "x double")
    with pytest.raises(ValueError):
        cluster.sweep(same, ["x"], [2], max_iter=2)


def test_labels_are_nearest_centres(spark, blobs, trained):
    made = trained.model.transform(blobs)
    assert made.count() == 300
    groups = as_set(made.select("truth", "prediction").distinct())
    assert len(groups) == 3 and {p for _, p in groups} == {0, 1, 2}
    scaled = features.standardize(blobs, ["x", "y"])
    points = cluster.kmeans_stage(trained.model).clusterCenters()
    mine = cluster.assign(scaled, ["x", "y"], points).select("id", "cluster")
    assert as_set(mine) == as_set(made.select("id", "prediction"))


def test_refit_gives_an_equal_split(blobs, trained):
    again = cluster.train(blobs, ["x", "y"], ks=[3], max_iter=20, refit=True)
    sizes = {r["n"] for r in cluster.sizes(again.model.transform(blobs), "prediction").collect()}
    assert sizes == {100}


def test_train_imputes_or_skips(spark, blobs):
    holes = blobs.withColumn("y", F.when(F.col("id") >= 3, F.col("y")))
    imputed = cluster.train(holes, ["x", "y"], ks=[3], max_iter=5)
    made = imputed.model.transform(holes)
    assert made.count() == 300 and made.where("y is null").count() == 0
    skipped = cluster.train(holes, ["x", "y"], ks=[3], max_iter=5, impute_nulls=False, invalid="skip")
    assert skipped.model.transform(holes).count() == 297
    with pytest.raises(ValueError):
        cluster.train(holes, ["x", "nope"], ks=[3])


def test_centres_table(spark, trained):
    named = cluster.centers(spark, trained.model, ["x", "y"])
    assert named.columns == ["cluster", "x", "y"] and named.count() == 3
    assert cluster.centers(spark, trained.model).columns == ["cluster", "f0", "f1"]


def test_save_load_score(spark, tmp_path, blobs, vectors, trained):
    path = cluster.save_model(trained.model, str(tmp_path / "model"))
    cluster.save_model(trained.model, path)
    scored = cluster.score(blobs, path, keep=["id", "absent"])
    assert scored.columns == ["id", "cluster"]
    want = trained.model.transform(blobs).select("id", "prediction")
    assert as_set(scored) == as_set(want)
    with pytest.raises(ValueError):
        cluster.score(blobs.drop("y"), path)

    bare = str(tmp_path / "bare")
    fitted = cluster.fit(vectors, 3)
    fitted.save(bare)
    assert isinstance(cluster.load_model(spark, bare), KMeansModel)
    assert cluster.score(vectors, bare).count() == 300
    with pytest.raises(ValueError):
        cluster.score(blobs, bare)


def test_report(spark, tmp_path, trained):
    path = sinks.write_report(trained.sweep.scores, str(tmp_path / "report"), {3: "/models/three"})
    assert sinks.best_model_path(spark, path) == "/models/three"
    doc = spark.read.json(path)
    assert doc.count() == 1
    assert doc.select("best.k").first()[0] == 3
    assert [r["k"] for r in doc.select(F.inline("sweep")).collect()] == [2, 3, 4, 5]
    bare = sinks.write_report(trained.sweep.scores, str(tmp_path / "bare"))
    with pytest.raises(ValueError):
        sinks.best_model_path(spark, bare)


def test_missing_parts_have_no_cluster(spark):
    rows = [(1.0, 1.0), (1.0, float("nan")), (None, 0.0), (9.0, 9.0)]
    df = spark.createDataFrame(rows, "`a.b` double, y double")
    cols, centers = ["a.b", "y"], [(0.0, 0.0), (9.0, 9.0)]
    assert [r["cluster"] for r in cluster.assign(df, cols, centers).collect()] == [0, None, None, 1]
    step = {tuple(r) for r in cluster.lloyd_step(df, cols, centers).collect()}
    assert step == {(0, 1, 1.0, 1.0), (1, 1, 9.0, 9.0)}


def test_joint_scores_equal_single_ones(spark):
    df = spark.range(200).select((F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"))
    sets = {1: [(0.0, 0.0)], 2: [(1.0, 1.0), (8.0, 5.0)], 3: [(1.0, 1.0), (5.0, 3.0), (8.0, 5.0)]}
    joint = cluster.silhouettes(df, ["x", "y"], sets)
    assert joint[1] is None
    for k in (2, 3):
        single = cluster.silhouette(cluster.assign(df, ["x", "y"], sets[k]), ["x", "y"], k).first()[0]
        assert abs(joint[k] - single) < 1e-12


def test_training_never_narrows(spark, tmp_path):
    df = spark.range(0, 640, 1, 64).select((F.col("id") % 5).cast("double").alias("x"))
    trained = cluster.train(df, ["x"], ks=[2], max_iter=2, partitions=4)
    assert trained.sweep.best == 2
