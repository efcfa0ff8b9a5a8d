import json
import random

import pytest
from conftest import as_set, plan_of
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gristmill import plans, presets, sinks, sources
from gristmill.operators import cluster

HEADER = ["code", "product_name", "brands", "energy-kj_100g", "Fat_100g", "carbohydrates_100g", "salt_100g"]
KINDS = [(1500, 5, 60, 1), (3000, 80, 5, 0.5), (200, 1, 8, 3)]


@pytest.fixture(scope="module")
def products(tmp_path_factory):
    rng = random.Random(11)
    lines = ["\t".join(HEADER)]
    for i in range(240):
        energy, fat, carbs, salt = (v * (1 + rng.gauss(0, 0.02)) for v in KINDS[i % 3])
        numbers = [f"{v:.4f}".replace(".", ",") for v in (energy, fat, carbs, salt)]
        lines.append("\t".join([f"c{i}", f"name {i}", f"brand{i % 7}", *numbers]))
    lines += [
        "bad1\tx\ty\t1500\t140\t60\t1",
        "bad2\tx\ty\t1500\tunknown\t60\t1",
        "bad3\tx\ty\t\t\t\t",
    ]
    path = tmp_path_factory.mktemp("products") / "products.tsv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def training_table(spark, products):
    raw = sources.read_delimited(spark, products)
    return raw.toDF(*[{"Fat_100g": "fat_100g", "energy-kj_100g": "energy_100g"}.get(c, c) for c in raw.columns])


def test_profile(spark, products):
    found = plans.profile_table(plans.load_export(spark, products, "tsv"))
    assert found.mapping == {
        "energy": "energy-kj_100g", "fat": "Fat_100g", "carbs": "carbohydrates_100g", "salt": "salt_100g",
    }
    nulls = {r["column"]: r["nulls"] for r in found.nulls.collect()}
    assert nulls == {"energy": 1, "fat": 2, "carbs": 1, "salt": 1}
    summary = {r["column"]: r for r in found.summary.collect()}
    assert summary["fat"]["max"] == 140 and summary["salt"]["count"] == 242
    assert found.rows.first()[0] == 243
    assert found.head.count() == 20 and found.ids.count() == 10
    assert found.ids.columns == ["code", "product_name", "brands"]


def test_profile_without_features(spark):
    with pytest.raises(ValueError):
        plans.profile_table(spark.createDataFrame([("1",)], "code string"))


def test_json_export(spark, tmp_path):
    rows = [
        {"code": "1", "nutriments": {"energy_kj_100g": 10.5, "fat_100g": 1}},
        {"code": "2", "nutriments": {"fat_100g": 2.5, "saturated_fat_100g": 0.5}},
    ]
    path = tmp_path / "p.jsonl"
    path.write_text("\n".join(map(json.dumps, rows)))
    df = plans.load_export(spark, str(path), "jsonl")
    found = plans.profile_table(df)
    assert found.mapping == {
        "energy": "energy-kj_100g", "fat": "fat_100g", "saturated_fat": "saturated-fat_100g",
    }
    assert {r["column"]: r["nulls"] for r in found.nulls.collect()}["energy"] == 1


def test_prepare(spark, products, tmp_path):
    out, small = str(tmp_path / "full"), str(tmp_path / "sample")
    full = plans.prepare_features(
        sources.read_delimited(spark, products), out=out, sample_out=small, target=100
    )
    assert full.columns == ["code", "product_name", "brands", "energy", "fat", "carbs", "salt", "features"]
    assert full.count() == 240
    assert not {"bad1", "bad2", "bad3"} & {r["code"] for r in full.collect()}
    z = full.select(vector_to_array("features").alias("z"))
    stats = z.agg(
        *[F.avg(F.col("z")[i]).alias(f"m{i}") for i in range(4)],
        *[F.stddev_samp(F.col("z")[i]).alias(f"s{i}") for i in range(4)],
    ).first()
    assert all(abs(stats[f"m{i}"]) < 1e-9 and abs(stats[f"s{i}"] - 1) < 1e-9 for i in range(4))
    taken = spark.read.parquet(small)
    assert 50 < taken.count() < 150
    assert as_set(taken.select("code")) <= as_set(full.select("code"))


def test_train_and_inspect(spark, training_table, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("model", "predictions", "report", "sample", "labels", "centers")}
    trained = plans.train_clusters(
        training_table, paths["model"], paths["predictions"], paths["report"], paths["sample"],
        ks=range(2, 5), max_iter=20, save_each=True,
    )
    assert trained.sweep.best == 3
    made = spark.read.parquet(paths["predictions"])
    assert made.columns == ["energy_100g", "fat_100g", "carbohydrates_100g", "salt_100g", "prediction"]
    # Out of range goes; a missing number is imputed; a row without numbers goes.
    assert made.count() == 241 and made.where("fat_100g is null").count() == 0
    assert spark.read.parquet(paths["sample"]).count() == 241
    best = sinks.best_model_path(spark, paths["report"])
    assert best.startswith(paths["model"])
    assert cluster.kmeans_stage(cluster.load_model(spark, paths["model"] + "_k4")).getK() == 4

    numbers = spark.read.parquet(paths["sample"])
    found = plans.inspect_clusters(
        numbers.withColumn("code", F.monotonically_increasing_id().cast("string")),
        best, paths["labels"], paths["centers"], profile_cols=presets.TRAINING_COLUMNS[:1], n_examples=2,
    )
    assert found.silhouette > 0.8
    assert sum(r["n"] for r in found.sizes.collect()) == 241
    assert found.examples.count() == 6
    assert found.profile.columns == ["cluster", "n", "avg_energy_100g"]
    assert spark.read.parquet(paths["labels"]).columns == ["code", "cluster"]
    assert sources.read_delimited(spark, paths["centers"], sep=",").count() == 3


def test_predictions_cover_all_rows_of_a_sampled_training(spark, training_table, tmp_path):
    out, small = str(tmp_path / "predictions"), str(tmp_path / "sample")
    plans.train_clusters(
        training_table, str(tmp_path / "m"), out, sample_out=small, ks=[2], max_iter=2, max_rows=100
    )
    assert spark.read.parquet(small).count() <= 100
    assert spark.read.parquet(out).count() == 241


def test_inspect_predictions_without_ids(spark, training_table, tmp_path):
    out, model = str(tmp_path / "predictions"), str(tmp_path / "m")
    plans.train_clusters(training_table, model, out, ks=[2], max_iter=5)
    found = plans.inspect_clusters(spark.read.parquet(out).drop("prediction"), model, n_examples=1)
    assert found.examples.count() == 2


def test_command_line(spark, products, training_table, tmp_path, capsys):
    from gristmill.__main__ import main

    main(["profile", "--input", products])
    assert "Fat_100g" in capsys.readouterr().out
    main(["prepare", "--input", products, "--out", str(tmp_path / "full")])
    assert spark.read.parquet(str(tmp_path / "full")).count() == 240
    table = str(tmp_path / "table")
    training_table.write.parquet(table)
    model = str(tmp_path / "model")
    main(["train", "--input", table, "--format", "parquet", "--model-out", model, "--fast"])
    # The trained columns of the first table are numbers only after parsing.
    numbers = str(tmp_path / "numbers")
    cols = ["energy_100g", "fat_100g", "carbohydrates_100g", "salt_100g"]
    training_table.select(
        "code", *[F.translate(c, ",", ".").try_cast("double").alias(c) for c in cols]
    ).write.parquet(numbers)
    labels = str(tmp_path / "labels")
    main(["inspect", "--input", numbers, "--format", "parquet", "--model", model, "--predictions-out", labels])
    assert "silhouette" in capsys.readouterr().out
    assert spark.read.parquet(labels).count() == 243
    words = str(tmp_path / "words")
    main(["words", "--input", products, "--column", "product_name", "--out", words])
    counts = {r["word"]: r["n"] for r in spark.read.parquet(words).collect()}
    assert counts["name"] == 240


def test_prepare_train_inspect_chain(spark, products, tmp_path):
    """The stored features of one workload are the next one's input; a raw export can be inspected."""
    paths = {n: str(tmp_path / n) for n in ("features", "model", "report", "model2", "bad")}
    raw = plans.load_export(spark, products, "tsv", quarantine=paths["bad"])
    stored = plans.prepare_features(raw, out=paths["features"])
    names = ["energy", "fat", "carbs", "salt"]
    trained = plans.train_clusters(
        stored, paths["model"], report_out=paths["report"], cols=names, bounds={}, parse=None,
        ks=range(2, 4), max_iter=5, refit=True,
    )
    assert trained.final_silhouette is None or -1 <= trained.final_silhouette <= 1
    assert sum(r["n"] for r in trained.final_sizes.collect()) == stored.count()
    best = sinks.best_model_path(spark, paths["report"])
    found = plans.inspect_clusters(stored, best, n_examples=1)
    assert sum(r["n"] for r in found.sizes.collect()) == stored.count()
    again = plans.inspect_clusters(raw, best, synonyms=presets.NUTRIENT_SYNONYMS, parse="strict")
    assert sum(r["n"] for r in again.sizes.collect()) == raw.count()


def test_profile_reads_its_input_once(spark, products):
    seen = plans.profile_table(sources.read_delimited(spark, products))
    for part in (seen.summary, seen.nulls, seen.rows):
        assert "FileScan" not in plan_of(part)
    assert seen.rows.first()["n_rows"] == sources.read_delimited(spark, products).count()
