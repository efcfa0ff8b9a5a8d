"""The four workloads, composed from the operators.

Defaults are the nutrition export's; every name, range and size is an argument.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill import presets, scratch, sinks, sources
from gristmill.functions import quoted
from gristmill.operators import clean, cluster, columns, features, profile, sample


def load_export(
    spark: SparkSession,
    path: str,
    format: str,
    struct: str = "nutriments",
    synonyms: Mapping[str, Sequence[str]] = presets.PROFILE_SYNONYMS,
    quarantine: str | None = None,
    **options,
) -> DataFrame:
    """Read a dump; of a JSON dump also lift the nutrient struct to top-level columns.

    With ``quarantine``, delimited text is parsed once and stored; rows with too many or too few
    fields are written there, and the others come back from storage.
    """
    if quarantine is not None:
        if format not in ("tsv", "csv"):
            raise ValueError("only delimited text has a quarantine")
        stored = scratch.folder(spark, "export")
        good, bad = sources.store_split(spark, path, stored, sep="\t" if format == "tsv" else ",", **options)
        sinks.write_parquet(bad, quarantine)
        return good
    df = sources.read_any(spark, path, format, **options)
    if format != "jsonl":
        return df
    spellings = [s for names in synonyms.values() for s in names]
    return columns.flatten_struct(df, struct, spellings, missing="omit")


def load_exports(
    spark: SparkSession,
    paths: Sequence[str],
    synonyms: Mapping[str, Sequence[str]] = presets.PROFILE_SYNONYMS,
    required: bool | Sequence[str] = True,
    keep: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Several delimited exports under logical names, each file by its own header.

    A scan maps columns by their place, so files of different headers are never scanned together:
    they are grouped by header, each group resolves the synonyms for itself, and the groups are
    put together by logical name, null where a group has no such column. The driver reads one
    line of each path; files below one path must share a header.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        groups.setdefault(tuple(sources.read_delimited(spark, path, **options).columns), []).append(path)
    parts = []
    for same in groups.values():
        df = sources.read_delimited(spark, same, **options)
        parts.append(columns.select_resolved(df, columns.resolve(df, synonyms, required=required), keep=keep))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


@dataclass
class Profile:
    mapping: dict[str, str]
    summary: DataFrame
    nulls: DataFrame
    rows: DataFrame
    head: DataFrame
    ids: DataFrame


def profile_table(
    df: DataFrame,
    synonyms: Mapping[str, Sequence[str]] = presets.PROFILE_SYNONYMS,
    ids: Sequence[str] = presets.ID_COLUMNS,
    head: int = 20,
    id_rows: int = 10,
) -> Profile:
    """First look at a dump: which features exist, their summary, their gaps."""
    mapping = columns.resolve(df, synonyms, required=True)
    numbers = clean.parse_columns(columns.select_resolved(df, mapping), list(mapping))
    seen = profile.overview(numbers)
    return Profile(
        mapping=mapping,
        summary=seen.drop("n_rows", "nulls"),
        nulls=seen.select("position", "column", "type", "nulls"),
        rows=seen.select("n_rows").limit(1),
        head=profile.head(df, head),
        ids=profile.head(columns.select_present(df, ids), id_rows),
    )


def clean_features(
    df: DataFrame,
    synonyms: Mapping[str, Sequence[str]],
    bounds: Mapping[str, tuple[float, float]],
    ids: Sequence[str],
    parse: str = "strict",
    nulls: str = "reject",
) -> tuple[DataFrame, list[str]]:
    """Ids and parsed features of the plausible rows; the names of the features."""
    mapping = columns.resolve(df, synonyms, required=True)
    names = list(mapping)
    rows = clean.parse_columns(columns.select_resolved(df, mapping, keep=ids), names, parse)
    rows = clean.filter_bounds(rows, {c: b for c, b in bounds.items() if c in names}, nulls)
    keep = clean.complete_cases if nulls == "reject" else clean.drop_all_null
    return keep(rows, names), names


def prepare_features(
    df: DataFrame,
    out: str | None = None,
    sample_out: str | None = None,
    synonyms: Mapping[str, Sequence[str]] = presets.NUTRIENT_SYNONYMS,
    bounds: Mapping[str, tuple[float, float]] = presets.FEATURE_BOUNDS,
    ids: Sequence[str] = presets.ID_COLUMNS,
    target: int = presets.SAMPLE_TARGET,
    seed: int = presets.SEED,
) -> DataFrame:
    """Complete plausible rows with a standardised ``features`` vector.

    The raw text is parsed once: the cleaned rows are written before the scaler is
    fitted. With ``out`` the result is written there, with ``sample_out`` also about
    ``target`` rows of it.
    """
    rows, names = clean_features(df, synonyms, bounds, ids)
    rows = scratch.materialize(rows, "clean")
    chain = Pipeline(stages=features.stages(names, impute_nulls=False, invalid="skip"))
    result = chain.fit(rows).transform(rows).drop("features_raw")
    if out is None and sample_out is None:
        return result
    spark = df.sparkSession
    stored = spark.read.parquet(sinks.write_parquet(result, out or scratch.folder(spark, "features")))
    wrong = features.bad_vectors(stored, "features", len(names)).first()["n_bad"]
    if wrong:
        raise ValueError(f"{wrong} feature vectors are missing or not of length {len(names)}")
    if sample_out is not None:
        sinks.write_parquet(sample.to_target(stored, target, seed), sample_out)
    return stored


def train_clusters(
    df: DataFrame,
    model_out: str,
    predictions_out: str | None = None,
    report_out: str | None = None,
    sample_out: str | None = None,
    cols: Sequence[str] = presets.TRAINING_COLUMNS,
    bounds: Mapping[str, tuple[float, float]] = presets.TRAINING_BOUNDS,
    parse: str | None = "lenient",
    max_rows: int | None = None,
    save_each: bool = False,
    seed: int = presets.SEED,
    **training,
) -> cluster.Trained:
    """Parse, keep plausible (also partial) rows, choose k, save model and predictions.

    All rows are trained on, unless ``max_rows`` asks for a sample of that many; predictions
    cover every plausible row either way. ``parse=None`` takes columns that are numbers
    already. ``training`` goes to ``cluster.train``.
    """
    rows = columns.select_present(df, cols, required=True)
    names = rows.columns
    if parse is not None:
        rows = clean.parse_columns(rows, names, parse)
    known = {c: b for c, b in bounds.items() if c in names}
    rows = clean.drop_all_null(clean.filter_bounds(rows, known, nulls="keep"), names)
    rows = scratch.materialize(rows, "training")
    chosen = rows if max_rows is None else sample.to_target(rows, max_rows, seed, cap=True)
    if sample_out is not None:
        chosen = df.sparkSession.read.parquet(sinks.write_parquet(chosen, sample_out))
    trained = cluster.train(chosen, names, seed=seed, **training)
    trained.final_silhouette, trained.final_sizes = cluster.final_report(trained.model, rows)
    cluster.save_model(trained.model, model_out)
    paths = {trained.sweep.best: model_out}
    if save_each:
        for k, model in trained.candidates.items():
            paths[k] = cluster.save_model(model, f"{model_out}_k{k}")
    if predictions_out is not None:
        made = trained.model.transform(rows).select(*names, "prediction")
        sinks.write_parquet(made, predictions_out)
    if report_out is not None:
        sinks.write_report(trained.sweep.scores, report_out, paths)
    return trained


@dataclass
class Inspection:
    silhouette: float | None
    labelled: DataFrame
    sizes: DataFrame
    profile: DataFrame
    examples: DataFrame
    centers: DataFrame


def inspect_clusters(
    df: DataFrame,
    model_path: str,
    predictions_out: str | None = None,
    centers_out: str | None = None,
    ids: Sequence[str] = presets.ID_COLUMNS,
    profile_cols: Iterable[str] = (),
    n_examples: int = 5,
    label: str = "cluster",
    synonyms: Mapping[str, Sequence[str]] | None = None,
    parse: str | None = None,
) -> Inspection:
    """Label every row with a saved model and report on the clusters.

    ``synonyms`` finds the model's columns under other spellings, ``parse`` ("strict" or
    "lenient") reads them from text, so a raw export can be given as it is.

    The labelled rows are written once; the reports read them. The profile's means are
    those of the unscaled columns, gaps filled the way the model fills them.
    """
    spark = df.sparkSession
    profile_cols = list(profile_cols)
    model = cluster.load_model(spark, model_path)
    inputs = cluster.input_columns(model)
    if synonyms is not None:
        found = columns.resolve(df, {c: synonyms.get(c, [c]) for c in inputs}, required=True)
        df = columns.select_resolved(df, found, keep=[c for c in [*ids, *profile_cols] if c in df.columns and c not in found])
    columns.require(df, inputs)
    if parse is not None:
        df = clean.parse_columns(df, inputs, parse)
    made, vector = cluster.kmeans_stage(model).getPredictionCol(), cluster.kmeans_stage(model).getFeaturesCol()
    # A table that was prepared or labelled before has columns that the model makes anew.
    df = df.drop(*[c for c in (vector, f"{vector}_raw", made) if c not in inputs])
    labelled = model.transform(df)
    if made != label:
        labelled = labelled.withColumnRenamed(made, label)
    have = [c for c in ids if c in df.columns]
    # Only what the reports read is written.
    needed = [*have, label, vector, *profile_cols]
    if not have:
        needed += [c for c in df.columns if c not in needed]
    labelled = labelled.select(*[F.col(quoted(c)) for c in dict.fromkeys(needed)])
    labelled = scratch.materialize(labelled, "labelled")
    if predictions_out is not None:
        sinks.write_parquet(labelled.select(*have, label), predictions_out)
    points = cluster.centers(spark, model)
    if centers_out is not None:
        sinks.write_small_csv(points, centers_out)
    return Inspection(
        silhouette=cluster.evaluate(labelled, label, vector),
        labelled=labelled,
        sizes=cluster.sizes(labelled, label),
        profile=cluster.profile(labelled, profile_cols, label),
        examples=cluster.examples(labelled, have, n_examples, label),
        centers=points,
    )
