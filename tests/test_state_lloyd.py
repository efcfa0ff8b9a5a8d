"""Stored profiles, joint k-means, two-level examples, clustered files and stored quarantine."""

import json
import math

import pyarrow.parquet as pq
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from gristmill import scratch, sinks, sources
from gristmill.operators import cluster, columns, features, lloyd, profile, state
from gristmill.plans import catalog, workloads
from gristmill.plans import fixtures as fx


@pytest.fixture(scope="module")
def points(spark):
    rows = spark.range(3000).select(
        (F.col("id") % 3 * 4 + F.randn(1)).alias("x"),
        (F.col("id") % 2 * 5 + F.randn(2)).alias("y"),
        F.when(F.col("id") == 7, F.lit(math.nan)).when(F.col("id") == 8, F.lit(None)).otherwise(F.lit(1.0)).alias("gap"),
        "id",
    )
    return scratch.materialize(rows, "points")


# ---- profile state -----------------------------------------------------------------


def test_merged_state_equals_one_scan(spark):
    rows = spark.range(5000).select((F.col("id") % 7).alias("g"), (1e9 + F.rand(5)).alias("a"), F.when(F.col("id") % 7 > 2, F.col("id")).alias("b"), F.lit(None).cast("double").alias("c"))
    cols = ["a", "b", "c"]
    slices = state.profile_state(rows, cols, by=["g"])
    merged = {r["column"]: r.asDict() for r in state.summary(state.merge_states(slices)).collect()}
    for r in profile.overview(rows, cols).collect():
        for name, value in r.asDict().items():
            got = merged[r["column"]][name]
            assert got == value or math.isclose(got, value, rel_tol=1e-12 if name != "stddev" else 1e-7), (r["column"], name)
    per_slice = state.merge_states(slices, by=["g"])
    assert per_slice.count() == 21
    assert state.merge_states(slices.where("false")).collect() == []


# ---- joint k-means -----------------------------------------------------------------


@pytest.mark.parametrize("key", [(), ("id",)])
def test_fit_does_not_depend_on_partitions(points, key):
    found = []
    for parts in (1, 8, 64):
        dealt = points.repartition(parts, F.rand(parts))
        starts = lloyd.seeds(dealt, ["x", "y"], [2, 6], key)
        fits = lloyd.iterate(dealt, ["x", "y"], starts, 30, 1e-6)
        found.append({k: (fit.sizes, [v for c in fit.centers for v in c]) for k, fit in fits.by_k.items()})
    for other in found[1:]:
        for k, (sizes, numbers) in found[0].items():
            assert other[k][0] == sizes
            assert other[k][1] == pytest.approx(numbers, abs=1e-9)


def test_all_k_share_each_scan(points, monkeypatch):
    calls = []
    step = lloyd.step
    monkeypatch.setattr(lloyd, "step", lambda *a: calls.append(sorted(a[2])) or step(*a))
    starts = {k: [(float(i), float(i)) for i in range(k)] for k in (2, 3, 6)}
    fits = lloyd.iterate(points, ["x", "y"], starts, 40, 1e-6)
    assert len(calls) == fits.passes == max(f.iterations for f in fits.by_k.values())
    assert calls[0] == [2, 3, 6]
    plan = plan_of(step(points, ["x", "y"], starts))
    assert plan.count("Scan parquet") == 1


def test_joint_steps_equal_single_ones(points):
    centers = {2: [(0.0, 0.0), (5.0, 5.0)], 3: [(0.0, 1.0), (4.0, 4.0), (8.0, 1.0)]}
    got = lloyd.step(points, ["x", "y"], centers).collect()
    for k, at in centers.items():
        want = {r["cluster"]: r for r in cluster.lloyd_step(points, ["x", "y"], at).collect()}
        mine = {r["c"]: r for r in got if r["k"] == k}
        assert {c: r["n"] for c, r in mine.items()} == {c: r["n"] for c, r in want.items()}
        for c, r in mine.items():
            assert (r["x0"], r["x1"]) == pytest.approx((want[c]["x"], want[c]["y"]), abs=1e-9)


def test_silhouettes_equal_the_evaluator(points):
    centers = {2: [(0.0, 0.0), (5.0, 5.0)], 4: [(0.0, 1.0), (4.0, 4.0), (8.0, 1.0), (1e6, 1e6)]}
    got = lloyd.silhouettes(points, ["x", "y"], centers)
    vectors = features.assemble(points.select("x", "y"), ["x", "y"])
    for k, at in centers.items():
        labelled = cluster.assign(vectors, ["x", "y"], at, "prediction")
        assert got[k] == pytest.approx(cluster.evaluate(labelled), abs=1e-9)
    assert lloyd.silhouettes(points, ["x", "y"], {1: [(0.0, 0.0)]}) == {1: None}


def test_missing_parts_and_few_points(spark, points):
    (row,) = lloyd.step(points, ["x", "gap"], {1: [(0.0, 0.0)]}).collect()
    assert row["n"] == 2998
    few = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (None,)], "x double")
    assert {k: sorted(v) for k, v in lloyd.seeds(few, ["x"], [1, 4]).items()}[4] == [(1.0,), (2.0,)]
    with pytest.raises(ValueError):
        lloyd.seeds(few.where("x is null"), ["x"], [2])


def test_models_have_the_given_centers(spark, points, tmp_path):
    at = [(1.5, 2.0), (0.1, -3.0), (7.0, 1e-9)]
    model = lloyd.model_of(spark, at)
    assert sorted(map(tuple, model.clusterCenters())) == sorted(at)
    path = cluster.save_model(model, str(tmp_path / "model"))
    loaded = cluster.kmeans_stage(cluster.load_model(spark, path))
    assert [tuple(c) for c in loaded.clusterCenters()] == [tuple(c) for c in model.clusterCenters()]


def test_checks_of_sweep_and_labels_see_wrong_ones(spark, data):
    rows, trained = catalog._train(spark, data, ks=[3, 4], max_iter=5, tol=1e-3)
    good = catalog._sweep_holds(trained, 1e-9).collect()
    n = rows.count()
    assert {(r["n_fitted"], r["n_rows"], r["cost_falls"], r["same_score"], r["best_is_marked"]) for r in good} == {(n, n, True, True, True)}
    # A sweep over a part of the rows, and one whose scores are another sweep's.
    _, cut = catalog._train(spark, data, ks=[3, 4], max_iter=5, tol=1e-3)
    part = trained.points.where("f0 > 0")
    cut.sweep = cluster.sweep(part, [c for c in part.columns if c.startswith("f")], [3, 4], 5, 1e-3)
    bad = catalog._sweep_holds(cut, 1e-9).collect()
    assert all(r["n_fitted"] != n and not r["same_score"] for r in bad)
    centers = cluster.kmeans_stage(trained.model).clusterCenters()
    made = trained.model.transform(rows)
    k = len(centers)
    assert catalog._labels_hold(made, centers, "prediction").first()["n_nearest"] == n
    turned = made.withColumn("prediction", (F.col("prediction") + 1) % k)
    assert catalog._labels_hold(turned, centers, "prediction").first()["n_nearest"] < n


# ---- examples, clustered files, quarantine, headers, variants ----------------------------


def test_examples_meet_in_two_levels(spark):
    rows = spark.range(0, 20_000, 1, 1000).select("id", (F.col("id") % 2).cast("int").alias("cluster"))
    found = cluster.examples(rows, ["id"], 3)
    plan = plan_of(found)
    assert plan.count("WindowGroupLimit") >= 4 and cluster.SALT in plan
    assert sorted((r["cluster"], r["place"], r["id"]) for r in found.collect()) == [(0, 1, 0), (0, 2, 2), (0, 3, 4), (1, 1, 1), (1, 2, 3), (1, 3, 5)]


def test_clustered_files_are_skipped(spark, data, tmp_path):
    items = spark.read.parquet(f"{data}/lineitem.parquet").select("l_quantity", "l_extendedprice")
    path = sinks.write_clustered(items, str(tmp_path / "clustered"), fx.LINE_BOUNDS, files=16)
    files = sorted((tmp_path / "clustered").glob("*.parquet"))

    def may_match(file):
        groups = pq.ParquetFile(file).metadata
        return any(
            all(
                groups.row_group(g).column(c).statistics.max >= low and groups.row_group(g).column(c).statistics.min <= high
                for c, (low, high) in enumerate(fx.NARROW_BOUNDS.values())
            )
            for g in range(groups.num_row_groups)
        )

    assert len(files) == 16
    assert 0 < sum(map(may_match, files)) <= 6
    assert spark.read.parquet(path).count() == items.count()
    with pytest.raises(ValueError):
        sinks.z_order({}, 8)


def test_z_order_of_missing_and_far_values(spark):
    rows = spark.createDataFrame([(0.0, 0.0), (None, math.nan), (-9.0, -1.0), (1.0, 1.0), (99.0, math.inf), (1.0, 0.0)], "a double, b double")
    got = [r[0] for r in rows.select(sinks.z_order({"a": (0, 1), "b": (0, 1)}, 2)).collect()]
    assert got == [0, 0, 0, 15, 15, 10]


def test_quarantine_is_one_scan_of_the_text(spark, tmp_path):
    text = tmp_path / "in.tsv"
    text.write_text("code\tenergy_100g\n1\t10\n2\t20\textra\n3\n4\t40\n")
    good, bad = sources.store_split(spark, str(text), str(tmp_path / "out"))
    assert "Scan csv" not in plan_of(good)
    assert "PartitionFilters" in plan_of(good)
    assert sorted(tuple(r) for r in good.collect()) == [("1", "10"), ("4", "40")]
    assert sorted(r["code"] for r in bad.collect()) == ["2", "3"]
    clean_text = tmp_path / "clean.tsv"
    clean_text.write_text("code\tenergy_100g\n1\t10\n")
    good, bad = sources.store_split(spark, str(clean_text), str(tmp_path / "clean"))
    assert (good.count(), bad.count()) == (1, 0)


def test_exports_with_other_headers(spark, tmp_path):
    for name, text in {"a": "id\tfat\tsalt\n1\t2\t3\n", "b": "salt\tID\n9\t8\n", "c": "id\tfat\tsalt\n4\t5\t6\n"}.items():
        (tmp_path / f"{name}.tsv").write_text(text)
    paths = [str(tmp_path / f"{n}.tsv") for n in "abc"]
    names = {"id": ["id"], "fat": ["fat"], "salt": ["salt"]}
    got = workloads.load_exports(spark, paths, names, required=["id"])
    assert sorted(map(tuple, got.select("id", "fat", "salt").collect())) == [("1", "2", "3"), ("4", "5", "6"), ("8", None, "9")]


def test_variants_of_mixed_lines(spark, tmp_path):
    lines = [{"a": 1, "b": {"c-d": "x"}}, {"a": "2"}, {"a": [3]}, {"a": 4.6, "b": None}]
    (tmp_path / "in.jsonl").write_text("\n".join([*map(json.dumps, lines), "no json", ""]))
    read = sources.read_variants(spark, str(tmp_path / "in.jsonl"))
    got = columns.variant_fields(read, "value", {"a": ("$.a", "int"), "c": ("$.b['c-d']", "string")})
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted([(1, "x"), (2, None), (None, None), (4, None), (None, None)], key=repr)
    assert "VARIANT" in columns.variant_schema(read, "value").first()["schema"]
