"""K-means training, choice of k, scoring and cluster reports."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from gristmill import scratch
from gristmill.functions import nearest, quoted, squared_distance, squared_norm
from gristmill.operators import columns, features, lloyd, sample
from gristmill.operators.lloyd import silhouettes

SWEEP_SCHEMA = "k int, silhouette double"
SEED = 42
# Groups of tasks in which the first rows of a cluster are found before they meet.
SALTS = 64
SALT = "_salt"
# In a table of different points, the number of rows that each stands for.
WEIGHT = "_weight"

# ---- fixed centres -----------------------------------------------------------------


def assign(
    df: DataFrame,
    cols: Sequence[str],
    centers: Sequence[Sequence[float]],
    label: str = "cluster",
) -> DataFrame:
    """Add the number of the nearest centre (ties: the lower number; null or NaN part: null).

    Two projections over each row: no join, no shuffle. The code grows with k x d only,
    also where a later filter on the label is pushed below the projections.
    """
    distances = F.array(*[squared_distance(cols, c) for c in centers])
    return (
        df.withColumn("_distances", distances)
        .withColumn(label, nearest("_distances"))
        .drop("_distances")
    )


def lloyd_step(
    df: DataFrame, cols: Sequence[str], centers: Sequence[Sequence[float]]
) -> DataFrame:
    """One k-means iteration: ``cluster, n`` and the new mean of every column.

    Rows with a null or NaN part belong to no cluster and count nowhere.
    """
    return (
        assign(df.select(*[quoted(c) for c in cols]), cols, centers, "cluster")
        .where("cluster is not null")
        .groupBy("cluster")
        .agg(F.count(F.lit(1)).alias("n"), *[F.avg(quoted(c)).alias(c) for c in cols])
    )


# ---- reports over labelled rows ----------------------------------------------------


def sizes(df: DataFrame, label: str = "cluster") -> DataFrame:
    """``label, n`` in label order."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label)


def profile(df: DataFrame, cols: Sequence[str], label: str = "cluster") -> DataFrame:
    """Size and mean of each unscaled column per cluster."""
    means = [F.avg(F.col(quoted(c))).alias(f"avg_{c}") for c in cols]
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *means).orderBy(label)


def examples(
    df: DataFrame,
    ids: Sequence[str],
    n: int = 5,
    label: str = "cluster",
    order_by: Sequence | None = None,
) -> DataFrame:
    """The first ``n`` rows of every cluster by id, in one job.

    Without ids, all other columns that can be ordered are shown and give the order.

    Two levels: a task passes on at most ``n`` rows of each cluster, the first rows of its salt
    are found among those of one task in ``SALTS``, and the last task of a cluster sees ``n`` rows
    of each salt, however many tasks there are and however large one cluster is.
    """
    shown = list(ids)
    if not shown:
        plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
        shown = [c for c in plain if c != label]
    names = [F.col(quoted(c)) for c in shown]
    order = order_by or names or [F.lit(1)]
    rows = df.select(quoted(label), *names).withColumn(SALT, F.spark_partition_id() % SALTS)
    for level in ([quoted(label), SALT], [quoted(label)]):
        first = Window.partitionBy(*level).orderBy(*order)
        rows = rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= n)
    return rows.drop(SALT)


def silhouette(
    df: DataFrame, cols: Sequence[str], k: int, label: str = "cluster", weight: str | None = None
) -> DataFrame:
    """One row ``silhouette``: mean squared-Euclidean silhouette of labels ``0..k-1``.

    Closed form: the mean distance of x to a cluster is ``|x|^2 + mean|y|^2 - 2 x.mean(y)``,
    so two scans suffice and no pair of rows ever meets. The first brings k x (d + 2)
    numbers to the driver, the second is arithmetic on columns and literals. Rows alone
    in their cluster score 0, unlabelled rows do not count; with fewer than two
    non-empty clusters the result is null. With ``weight`` a row counts as that many equal ones.
    """
    xs = [f"x{j}" for j in range(len(cols))]
    heavy = F.lit(1) if weight is None else F.col(quoted(weight))

    def mean(name: str):
        return F.avg(name) if weight is None else F.sum(F.col(name) * F.col("w")) / F.sum(F.when(F.col(name).isNotNull(), F.col("w")))

    rows = df.select(
        F.col(quoted(label)).cast("int").alias("c"),
        heavy.alias("w"),
        *[F.col(quoted(name)).alias(x) for name, x in zip(cols, xs, strict=True)],
    ).withColumn("sq", squared_norm(xs))

    # Labels outside 0..k-1 are one group, so k + 1 rows come back whatever the labels.
    grouped = rows.where("c is not null").groupBy(F.when(F.col("c").between(0, k - 1), F.col("c")).alias("c")).agg(
        F.sum("w").alias("n"),
        mean("sq").alias("sq"),
        *[mean(x).alias(x) for x in xs],
        F.max("c").alias("largest"),
    )
    found = {r["c"]: r for r in grouped.collect()}
    if None in found:
        raise ValueError(f"{label} has values outside 0..{k - 1}, such as {found[None]['largest']}")
    if len(found) < 2:
        return df.sparkSession.createDataFrame([(None,)], "silhouette double")

    def distance(stats):
        cross = reduce(add, [F.col(x) * F.lit(stats[x]) for x in xs])
        return F.col("sq") + F.lit(stats["sq"]) - 2 * cross

    nothing = F.lit(None).cast("double")
    to_cluster = F.array(*[distance(found[c]) if c in found else nothing for c in range(k)])
    members = F.array(*[F.lit(float(found[c]["n"]) if c in found else 0.0) for c in range(k)])
    far = rows.select("c", "w", to_cluster.alias("d"), F.get(members, F.col("c")).alias("n"))
    others = F.array(*[F.when(F.col("c") != c, F.get("d", F.lit(c))) for c in range(k)])
    near = far.select(
        "n",
        "w",
        (F.get("d", F.col("c")) * F.col("n") / F.nullif(F.col("n") - 1, F.lit(0.0))).alias("a"),
        F.array_min(others).alias("b"),
    )
    widest = F.greatest("a", "b")
    score = (
        F.when((F.col("n") == 1) | (widest == 0), F.lit(0.0))
        .when(F.col("n") > 1, (F.col("b") - F.col("a")) / widest)
    )
    return near.select("w", score.alias("s")).agg(mean("s").alias("silhouette"))


def evaluate(
    predictions: DataFrame, label: str = "prediction", vector: str = "features"
) -> float | None:
    """Silhouette of vector rows by Spark ML; None when fewer than two clusters have rows."""
    evaluator = ClusteringEvaluator(
        featuresCol=vector,
        predictionCol=label,
        metricName="silhouette",
        distanceMeasure="squaredEuclidean",
    )
    several = predictions.groupBy(quoted(label)).agg(F.count(F.lit(1)).alias("n")).limit(2).count() > 1
    return evaluator.evaluate(predictions) if several else None


def best_k(sweep_scores: DataFrame) -> DataFrame:
    """The row of highest silhouette; the smallest k wins a tie, an unscored k never wins."""
    return (
        sweep_scores.where(F.col("silhouette").isNotNull())
        .orderBy(F.desc("silhouette"), F.asc("k"))
        .limit(1)
    )


# ---- training ----------------------------------------------------------------------


def fit(
    vectors: DataFrame,
    k: int,
    max_iter: int = 50,
    tol: float = 1e-4,
    seed: int = SEED,
    vector: str = "features",
    label: str = "prediction",
) -> KMeansModel:
    """K-means of Spark ML, for one k. The result depends on the partitioning, unlike that of ``sweep``.

    Give it a table on storage rather than a persisted one: the fit then caches the
    unpacked vectors itself instead of unpacking them in every iteration.
    """
    return KMeans(
        k=k, seed=seed, maxIter=max_iter, tol=tol, featuresCol=vector, predictionCol=label
    ).fit(vectors)


@dataclass
class Sweep:
    """Scores per k, the fitted models, and the chosen k."""

    scores: DataFrame
    models: Mapping[int, KMeansModel]
    best: int
    silhouettes: dict[int, float | None]
    fits: lloyd.Fits


def sweep(
    points: DataFrame,
    cols: Sequence[str],
    ks: Iterable[int] = range(3, 11),
    max_iter: int = 50,
    tol: float = 1e-4,
    seed: int = SEED,
    score_fraction: float | None = None,
    key: Sequence[str] = (),
    vector: str = "features",
    label: str = "prediction",
    weight: str | None = None,
) -> Sweep:
    """Fit every k on plain (scaled) columns, then score all of them together.

    All k share each scan: the draws that seed them, every iteration, and the two that score them.
    The value is the one Spark ML's evaluator gives. ``score_fraction`` scores on a Bernoulli
    sample of the points. With ``key`` columns the draws go by these, else by the coordinates.
    With ``weight`` a row stands for that many equal ones, and counts as these everywhere.
    The points are packed once, and the packed ones are read once an iteration and then deleted.
    """
    ks = sorted(set(ks))
    cols, key = list(cols), list(key)
    spark = points.sparkSession
    path = scratch.folder(spark, "blocks")
    packed = scratch.materialize(lloyd.blocks(points, cols, weight), "blocks", path)
    starts = lloyd.seeds(points, cols, ks, key, seed, weight=weight, packed=packed)
    fits = lloyd.iterate(packed, cols, starts, max_iter, tol)
    models = lloyd.Models(ks, lambda k: lloyd.model_of(spark, fits.by_k[k].centers, vector, label))
    scored = packed if score_fraction is None else lloyd.thinned(packed, score_fraction, seed)
    silhouettes_of = lloyd.silhouettes(scored, cols, {k: fit.centers for k, fit in fits.by_k.items()})
    scratch.release(spark, path)
    ranked = [k for k in ks if silhouettes_of[k] is not None]
    if not ranked:
        raise ValueError(f"no k of {ks} gave two non-empty clusters")
    best = max(ranked, key=lambda k: (silhouettes_of[k], -k))
    scores = spark.createDataFrame(list(silhouettes_of.items()), SWEEP_SCHEMA)
    scores = scores.withColumn("is_best", F.col("k") == F.lit(best))
    return Sweep(scores, models, best, silhouettes_of, fits)


@dataclass
class Trained:
    """A deployable model (prepare + cluster) with the sweep that chose its k."""

    model: PipelineModel
    sweep: Sweep
    cols: list[str]
    candidates: Mapping[int, PipelineModel]
    #: What was fitted: the different prepared features as columns ``f0..``, and in ``WEIGHT`` the rows that have them.
    points: DataFrame
    final_silhouette: float | None = None
    final_sizes: DataFrame | None = None


def train(
    df: DataFrame,
    cols: Sequence[str],
    ks: Iterable[int] = range(3, 11),
    max_iter: int = 50,
    tol: float = 1e-4,
    seed: int = SEED,
    score_fraction: float | None = None,
    key: Sequence[str] = (),
    impute_nulls: bool = True,
    invalid: str = "error",
    refit: bool = False,
    partitions: int | None = None,
) -> Trained:
    """Prepare, sweep k, and join the best clustering to the preparation stages.

    The prepared features are written once, as plain columns: equal ones as one row with
    their number, which every fit and score counts as that many. The final
    model reuses the best fit of the sweep; ``refit=True`` fits preparation and k-means
    of Spark ML again on ``df``, equal rows as one of that weight. ``key`` names columns that the draws go by. With ``partitions`` the
    points are dealt to that many tasks before they are written, for an input of few splits.
    """
    cols = list(cols)
    columns.require(df, cols)
    prepare = Pipeline(stages=features.stages(cols, impute_nulls, invalid))
    prepared = prepare.fit(df)
    names = [f"f{j}" for j in range(len(cols))]
    points = scratch.materialize(_counted(prepared, df, names, key, partitions), "points")
    found = sweep(points, names, ks, max_iter, tol, seed, score_fraction, key, weight=WEIGHT)
    candidates = lloyd.Models(found.models, lambda k: PipelineModel(stages=[*prepared.stages, found.models[k]]))
    if refit:
        last = KMeans(
            k=found.best,
            seed=seed,
            maxIter=max_iter,
            tol=tol,
            featuresCol="features",
            predictionCol="prediction",
            weightCol=WEIGHT,
        )
        again = prepare.fit(df)
        heavy = scratch.materialize(_counted(again, df, names, (), partitions), "refit")
        model = PipelineModel(stages=[*again.stages, last.fit(heavy.select(array_to_vector(F.array(*names)).alias("features"), WEIGHT))])
    else:
        model = candidates[found.best]
    return Trained(model, found, cols, candidates, points)


def _counted(prepared: PipelineModel, df: DataFrame, names: Sequence[str], key: Sequence[str], partitions: int | None) -> DataFrame:
    """The different prepared rows of ``df``, features as columns ``names``, and in ``WEIGHT`` how many are equal."""
    parts = vector_to_array("features")
    rows = prepared.transform(df).select(*[F.col(quoted(c)) for c in key], *[parts[j].alias(n) for j, n in enumerate(names)])
    held = [F.col(quoted(c)) for c in rows.columns]
    # The rows meet where they are dealt to, so they are shuffled once.
    dealt = rows if partitions is None else rows.repartition(partitions, *held)
    return dealt.groupBy(*held).agg(F.count(F.lit(1)).alias(WEIGHT))


def final_report(
    model: PipelineModel, df: DataFrame, share: float = 0.15, seed: int = 123
) -> tuple[float | None, DataFrame]:
    """How the model that is kept does: the silhouette on a Bernoulli sample of ``df``, and
    the cluster sizes over all of it."""
    made, vector = kmeans_stage(model).getPredictionCol(), kmeans_stage(model).getFeaturesCol()
    drawn = model.transform(sample.fraction(df, share, seed)).select(made, vector)
    return evaluate(drawn, made, vector), sizes(model.transform(df), made)


# ---- models: centres, storage, scoring ---------------------------------------------


def kmeans_stage(model: PipelineModel | KMeansModel) -> KMeansModel:
    stages = model.stages if isinstance(model, PipelineModel) else [model]
    found = [s for s in stages if isinstance(s, KMeansModel)]
    if not found:
        raise ValueError("the model has no k-means stage")
    return found[-1]


def input_columns(model: PipelineModel | KMeansModel) -> list[str]:
    """The columns that the first stage reads."""
    first = model.stages[0] if isinstance(model, PipelineModel) else model
    if first.hasParam("inputCols") and first.isSet("inputCols"):
        return first.getInputCols()
    return [first.getFeaturesCol()]


def centers(
    spark: SparkSession,
    model: PipelineModel | KMeansModel,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """``cluster`` plus one double per feature (``f0..`` unless named), standardised space."""
    points = kmeans_stage(model).clusterCenters()
    names = list(names) if names else [f"f{j}" for j in range(len(points[0]))]
    schema = "cluster int, " + ", ".join(f"{quoted(n)} double" for n in names)
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], schema)


def save_model(model: PipelineModel | KMeansModel, path: str) -> str:
    """Save as a pipeline model, replacing what is there."""
    whole = model if isinstance(model, PipelineModel) else PipelineModel(stages=[model])
    whole.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, path: str) -> PipelineModel | KMeansModel:
    """Load either kind of saved model, going by the class named in its metadata."""
    saved = json.loads(spark.read.text(f"{path}/metadata").first()[0])["class"]
    return (PipelineModel if saved.endswith(".PipelineModel") else KMeansModel).load(path)


def score(
    df: DataFrame,
    model: PipelineModel | KMeansModel | str,
    keep: Sequence[str] = (),
    label: str = "cluster",
) -> DataFrame:
    """Label every row with a fitted or saved model; result: the kept columns and the label."""
    if isinstance(model, str):
        model = load_model(df.sparkSession, model)
    columns.require(df, input_columns(model))
    made = kmeans_stage(model).getPredictionCol()
    labelled = model.transform(df)
    return labelled.select(
        *[F.col(quoted(c)) for c in keep if c in df.columns], F.col(made).alias(label)
    )
