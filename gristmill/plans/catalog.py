"""Registered queries over the given tables, one or more per operator.

Each takes ``(spark, sf_dir)`` and reads whole tables. The tables are free of gaps and
dirty numbers, so the expressions in ``gristmill.plans.fixtures`` put some in, the same
ones for a query and its SQL counterpart.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from multiprocessing.pool import ThreadPool
from operator import and_

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill import presets, scratch, sinks, sources
from gristmill.operators import clean, cluster, columns, features, lloyd, profile, sample, state, text
from gristmill.plans import fixtures as fx
from gristmill.plans import workloads

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A table for work that is heavy per row, dealt anew: its file may be one split."""
    return sources.spread(table(spark, sf_dir, name).select(*cols))


def rounded(df: DataFrame, cols, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def lineitem_with_gaps(spark, sf_dir) -> DataFrame:
    gaps = [F.expr(sql).alias(name) for name, sql in fx.GAPS.items()]
    return table(spark, sf_dir, "lineitem").select(*fx.LINE_KEY, *gaps)


def money(col) -> F.Column:
    """Exact sum of two-decimal amounts, as a double."""
    return F.sum(F.col(col).cast("decimal(18,2)")).cast("double")


# ---- sources and sinks -------------------------------------------------------------


@query
def tsv_roundtrip_sum(spark, sf_dir):
    """lineitem as gzip TSV, read back as strings, parsed strictly."""
    items = spread_table(
        spark, sf_dir, "lineitem", "l_returnflag", "l_quantity", "l_extendedprice"
    )
    rows = items.select(
        "l_returnflag",
        "l_quantity",
        F.translate(F.col("l_extendedprice").cast("string"), ".", ",").alias("price"),
    )
    path = sinks.write_delimited(rows, scratch.folder(spark, "tsv"), compression="gzip")
    read = sources.spread(sources.read_delimited(spark, path))
    parsed = clean.parse_columns(read, ["l_quantity", "price"])
    return parsed.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        money("l_quantity").alias("sum_qty"),
        money("price").alias("sum_price"),
    )


@query
def multiline_csv_roundtrip(spark, sf_dir):
    """documents as CSV with line breaks inside quoted fields."""
    docs = spread_table(spark, sf_dir, "documents", "doc_id", "lang", "text")
    path = sinks.write_delimited(docs, scratch.folder(spark, "multiline"), sep=",")
    read = sources.spread(sources.read_delimited(spark, path, sep=",", multiline=True))
    return read.select(
        F.col("doc_id").try_cast("bigint").alias("doc_id"),
        "lang",
        F.md5("text").alias("text_md5"),
        F.length("text").cast("bigint").alias("text_length"),
    )


@query
def inferred_csv_types(spark, sf_dir):
    """part as CSV, read with type inference."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    path = sinks.write_delimited(part, scratch.folder(spark, "infer"))
    read = sources.read_delimited(spark, path, infer=True)
    return read.select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"),
        "p_brand",
        "p_retailprice",
        F.typeof("p_brand").alias("brand_type"),
        F.typeof("p_retailprice").alias("price_type"),
    )


@query
def jsonl_flatten(spark, sf_dir):
    """events with nested props as JSON lines; one field lifted, one not there."""
    k = F.from_json("props", "k bigint")["k"]
    nested = table(spark, sf_dir, "events").select(
        "event_id", F.struct(k.alias("k_100")).alias("props")
    )
    path = sinks.write_jsonl(nested, scratch.folder(spark, "jsonl"))
    flat = columns.flatten_struct(sources.read_jsonl(spark, path), "props", ["k-100", "not-there"])
    return flat.select(
        "event_id", F.col("`k-100`").alias("k"), F.col("`not-there`").alias("not_there")
    )


@query
def format_dispatch(spark, sf_dir):
    """part written and read in every format."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    writers = {
        "tsv": sinks.write_delimited,
        "csv": lambda df, path: sinks.write_delimited(df, path, sep=","),
        "jsonl": sinks.write_jsonl,
        "parquet": sinks.write_parquet,
    }
    read = [
        sources.read_any(spark, write(part, scratch.folder(spark, name)), name).select(
            F.lit(name).alias("format"),
            F.col("p_size").cast("bigint").alias("size"),
            F.col("p_retailprice").cast("double").alias("price"),
        )
        for name, write in writers.items()
    ]
    return (
        reduce(DataFrame.unionAll, read)
        .groupBy("format")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("size").alias("sum_size"),
            money("price").alias("sum_price"),
        )
    )


@query
def corrupt_split(spark, sf_dir):
    """part as TSV with rows too long and too short; both sides of the quarantine."""
    lines = table(spark, sf_dir, "part").select(F.expr(fx.DAMAGED_PART).alias("value"))
    path = scratch.folder(spark, "damaged")
    lines.write.text(path)
    rows = sources.mark_corrupt(
        spark, path, schema="p_partkey string, p_brand string, p_size string", header=False
    )
    side = F.when(F.col(sources.CORRUPT).isNull(), "good").otherwise("bad").alias("side")
    return rows.groupBy(side).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("p_partkey").cast("bigint")).alias("sum_key")
    )


@query
def corrupt_stored(spark, sf_dir):
    """The same damaged rows parsed once and stored; each side is read from its own folder."""
    lines = table(spark, sf_dir, "part").select(F.expr(fx.DAMAGED_PART).alias("value"))
    path = scratch.folder(spark, "damaged")
    lines.write.text(path)
    sides = sources.store_split(
        spark, path, scratch.folder(spark, "split"), schema="p_partkey string, p_brand string, p_size string", header=False
    )
    told = [
        side.agg(F.lit(name).alias("side"), F.count(F.lit(1)).alias("n"), F.sum(F.col("p_partkey").cast("bigint")).alias("sum_key"))
        for name, side in zip(("good", "bad"), sides, strict=True)
    ]
    return reduce(DataFrame.unionAll, told)


@query
def jsonl_variants(spark, sf_dir):
    """events as JSON lines whose field is a number, a text or nothing, read without a schema."""
    events = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))
    path = scratch.folder(spark, "variants")
    events.select(F.expr(fx.MIXED_JSON).alias("value")).write.text(path)
    read = sources.read_variants(spark, path)
    return columns.variant_fields(
        read, "value", {"event_id": ("$.event_id", "bigint"), "k": ("$.props['k-100']", "bigint"), "not_there": ("$.props.none", "string")}
    )


@query
def exports_by_header(spark, sf_dir):
    """Two exports of part, the second with its columns in another order and under other names."""
    part = table(spark, sf_dir, "part")
    half = F.col("p_partkey") % 2 == 0
    one = part.where(half).select("p_partkey", F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"))
    two = part.where(~half).select(F.col("p_retailprice").alias("Retail-Price"), "p_brand", F.col("p_size").alias("SIZE_CM"), "p_partkey")
    paths = [sinks.write_delimited(df, scratch.folder(spark, "export")) for df in (one, two)]
    read = workloads.load_exports(spark, paths, fx.PART_SYNONYMS, required=["size", "price"], keep=["p_partkey"])
    numbers = clean.parse_columns(read, ["size", "price"])
    return numbers.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "size", "price", "brand")


@query
def clustered_range(spark, sf_dir):
    """A range of quantity and price from a copy of lineitem that is clustered by both."""
    items = table(spark, sf_dir, "lineitem").select(*fx.LINE_KEY, "l_quantity", "l_extendedprice")
    path = sinks.write_clustered(items, scratch.folder(spark, "clustered"), fx.LINE_BOUNDS, files=16)
    return clean.filter_bounds(sources.read_parquet(spark, path), fx.NARROW_BOUNDS)


@query
def small_csv_sink(spark, sf_dir):
    """A per-brand summary of part through the one-file CSV sink."""
    summary = profile.group_mean(table(spark, sf_dir, "part"), "p_brand", "p_retailprice")
    path = sinks.write_small_csv(summary, scratch.folder(spark, "small"))
    read = sources.read_delimited(
        spark, path, sep=",", schema="p_brand string, n bigint, avg double"
    )
    return rounded(read, ["avg"])


@query
def parquet_sink(spark, sf_dir):
    """orders through the parquet sink, read back by partition."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = sinks.write_parquet(
        orders, scratch.folder(spark, "orders"), partition_by=["o_orderstatus"]
    )
    return (
        sources.read_parquet(spark, path)
        .groupBy("o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n"), money("o_totalprice").alias("sum_price"))
    )


# ---- columns and filters -----------------------------------------------------------


@query
def resolve_synonyms(spark, sf_dir):
    """Logical columns of lineitem through spellings that miss, differ in case, or come second."""
    items = table(spark, sf_dir, "lineitem")
    mapping = columns.resolve(items, fx.LINE_SYNONYMS, required=["quantity", "price", "tax"])
    return columns.select_resolved(items, mapping, keep=fx.LINE_KEY)


@query
def select_present(spark, sf_dir):
    """The wanted columns of orders that exist, in the wanted order."""
    wanted = ["o_totalprice", "o_discount", "o_orderkey", "o_comment", "o_orderstatus"]
    return columns.select_present(table(spark, sf_dir, "orders"), wanted, required=True)


@query
def range_strict(spark, sf_dir):
    return clean.filter_bounds(lineitem_with_gaps(spark, sf_dir), fx.BOUNDS, nulls="reject")


@query
def range_null_tolerant(spark, sf_dir):
    return clean.filter_bounds(lineitem_with_gaps(spark, sf_dir), fx.BOUNDS, nulls="keep")


@query
def drop_all_null(spark, sf_dir):
    return clean.drop_all_null(lineitem_with_gaps(spark, sf_dir), list(fx.GAPS))


@query
def complete_cases(spark, sf_dir):
    return clean.complete_cases(lineitem_with_gaps(spark, sf_dir), list(fx.GAPS))


def dirty_prices(spark, sf_dir) -> DataFrame:
    dirty = F.expr(fx.DIRTY_PRICE).alias("price")
    return table(spark, sf_dir, "lineitem").select(*fx.LINE_KEY, dirty)


@query
def parse_strict(spark, sf_dir):
    return clean.parse_columns(dirty_prices(spark, sf_dir), ["price"], mode="strict")


@query
def parse_lenient(spark, sf_dir):
    return clean.parse_columns(dirty_prices(spark, sf_dir), ["price"], mode="lenient")


@query
def parse_lenient_documents(spark, sf_dir):
    """The first number inside every whole text."""
    docs = spread_table(spark, sf_dir, "documents", "doc_id", "text")
    return clean.parse_columns(docs.withColumnRenamed("text", "number"), ["number"], "lenient")


# ---- profiles ----------------------------------------------------------------------


@query
def word_count_space(spark, sf_dir):
    return text.word_count(spread_table(spark, sf_dir, "documents", "text"), "text", sep=" ")


@query
def word_count_ws(spark, sf_dir):
    return text.word_count(spread_table(spark, sf_dir, "documents", "text"), "text", sep=None)


@query
def row_count(spark, sf_dir):
    return profile.row_count(table(spark, sf_dir, "lineitem"))


@query
def describe(spark, sf_dir):
    summary = profile.describe(lineitem_with_gaps(spark, sf_dir), list(fx.GAPS))
    return rounded(summary, ["mean", "stddev", "min", "max"])


@query
def profile_merged(spark, sf_dir):
    """The summary of all rows from the stored states of seven slices."""
    rows = lineitem_with_gaps(spark, sf_dir)
    slices = scratch.materialize(state.profile_state(rows, list(fx.GAPS), by=["l_linenumber"]), "states")
    merged = state.summary(state.merge_states(slices))
    return rounded(merged, ["mean", "stddev", "min", "max"])


@query
def null_counts(spark, sf_dir):
    return profile.null_counts(lineitem_with_gaps(spark, sf_dir), list(fx.GAPS))


@query
def group_count_avg(spark, sf_dir):
    return rounded(
        profile.group_mean(table(spark, sf_dir, "events"), "event_type", "value"), ["avg"]
    )


@query
def head_ordered(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return profile.head(orders, 20, [F.desc("o_totalprice"), F.asc("o_orderkey")])


# ---- samples -----------------------------------------------------------------------


def _drawn(sampled: DataFrame, whole: DataFrame, low: float, high: float) -> DataFrame:
    """Whether a draw has no row more often than the table, and its size lies between two bounds."""
    drawn = sampled.groupBy(*fx.LINE_KEY).agg(F.count(F.lit(1)).alias("n"))
    there = whole.groupBy(*fx.LINE_KEY).agg(F.count(F.lit(1)).alias("most"))
    return drawn.join(there, fx.LINE_KEY, "left").agg(
        F.every(F.coalesce(F.col("n") <= F.col("most"), F.lit(False))).alias("in_table"),
        F.sum("n").between(low, high).alias("size_plausible"),
    )


def _six_sigma(n: int, share: float) -> float:
    return 6 * (n * share * (1 - share)) ** 0.5


@query
def sample_target(spark, sf_dir):
    """A Bernoulli draw of a third of lineitem, judged by what every such draw fulfils."""
    items = table(spark, sf_dir, "lineitem").select(*fx.LINE_KEY)
    n = items.count()
    drawn = scratch.materialize(sample.to_target(items, n // 3, total=n), "drawn")
    far = _six_sigma(n, 1 / 3)
    return _drawn(drawn, items, n // 3 - far, n // 3 + far)


@query
def sample_capped(spark, sf_dir):
    """The same draw, cut to the target where it is larger."""
    items = table(spark, sf_dir, "lineitem").select(*fx.LINE_KEY)
    n = items.count()
    drawn = scratch.materialize(sample.to_target(items, n // 3, cap=True, total=n), "drawn")
    return _drawn(drawn, items, n // 3 - _six_sigma(n, 1 / 3), n // 3)


@query
def sample_fraction(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(*fx.LINE_KEY)
    n = items.count()
    drawn = scratch.materialize(sample.fraction(items, 0.15), "drawn")
    far = _six_sigma(n, 0.15)
    return _drawn(drawn, items, 0.15 * n - far, 0.15 * n + far)


@query
def sample_keyed(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return sample.keyed(customers, "c_custkey", threshold=200, modulus=1000)


@query
def sample_keyed_capped(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sample.to_target(orders, 1_000, cap=True, key="o_orderkey")


# ---- features ----------------------------------------------------------------------


@query
def medians_exact(spark, sf_dir):
    found = features.medians(lineitem_with_gaps(spark, sf_dir), list(fx.GAPS), exact=True)
    return rounded(found, ["median"])


@query
def medians_narrowed(spark, sf_dir):
    """The exact medians by the search that large tables need."""
    found = features.medians(
        lineitem_with_gaps(spark, sf_dir),
        list(fx.GAPS),
        exact=True,
        window=1_000,
        sample=10_000,
    )
    return rounded(found, ["median"])


@query
def medians_approx(spark, sf_dir):
    """Whether each approximate median has a rank within a thousandth of the middle."""
    rows, cols = lineitem_with_gaps(spark, sf_dir), list(fx.GAPS)
    return _near_middle(rows, cols, {r["column"]: r["median"] for r in features.medians(rows, cols).collect()})


@query
def medians_merged(spark, sf_dir):
    """The same for medians that are read off the merged sketches of stored slices."""
    rows, cols = lineitem_with_gaps(spark, sf_dir), list(fx.GAPS)
    slices = scratch.materialize(features.quantile_sketches(rows, cols, by=["l_linenumber"]), "sketches")
    merged = features.sketched_quantiles(features.merge_sketches(slices), [0.5])
    return _near_middle(rows, cols, {r["column"]: r["value"] for r in merged.collect()})


def _near_middle(rows, cols, found) -> DataFrame:
    judged = []
    for c in cols:
        value, n = F.col(c).cast("double"), F.count(c)
        below, upto = F.count_if(value < found[c]) / n, F.count_if(value <= found[c]) / n
        near = (below - 0.001 <= 0.5) & (upto + 0.001 >= 0.5)
        judged.append(F.struct(F.lit(c).alias("column"), near.alias("rank_near_middle")))
    return rows.agg(F.array(*judged).alias("r")).select(F.inline("r"))


@query
def impute_median(spark, sf_dir):
    cols = list(fx.GAPS)
    return rounded(features.impute(lineitem_with_gaps(spark, sf_dir), cols, exact=True), cols)


@query
def moments(spark, sf_dir):
    found = features.moments(lineitem_with_gaps(spark, sf_dir), list(fx.GAPS))
    return rounded(found, ["mean", "stddev"])


@query
def standardize(spark, sf_dir):
    cols = list(fx.GAPS)
    return rounded(features.standardize(lineitem_with_gaps(spark, sf_dir), cols), cols)


def _unpacked(df: DataFrame, names) -> DataFrame:
    parts = vector_to_array("features")
    return df.select(
        *fx.LINE_KEY, *[F.round(parts[i], 4).alias(f"z_{n}") for i, n in enumerate(names)]
    )


@query
def vector_standardize(spark, sf_dir):
    """Fitted ML stages that drop incomplete rows, then scale."""
    cols = list(fx.GAPS)
    rows = lineitem_with_gaps(spark, sf_dir)
    fitted = Pipeline(stages=features.stages(cols, impute_nulls=False, invalid="skip")).fit(rows)
    return _unpacked(fitted.transform(rows), cols)


@query
def vector_impute(spark, sf_dir):
    """Fitted ML stages that put the (approximate) median into gaps, then scale.

    How many rows there are, and in how many every part is the value or the median, scaled by
    the moments of the filled column.
    """
    cols = list(fx.GAPS)
    rows = clean.drop_all_null(lineitem_with_gaps(spark, sf_dir), cols)
    fitted = Pipeline(stages=features.stages(cols, impute_nulls=True)).fit(rows)
    medians = fitted.stages[0].surrogateDF.first().asDict()
    filled = [F.coalesce(F.when(~F.isnan(c), F.col(c).cast("double")), F.lit(medians[c])) for c in cols]
    moments = rows.agg(*[f(x).alias(f"{n}{i}") for i, x in enumerate(filled) for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    parts = vector_to_array("features")
    made = fitted.transform(rows.withColumn("want", F.array(*[(x - moments[f"m{i}"]) / moments[f"s{i}"] for i, x in enumerate(filled)])))
    gaps = F.zip_with(parts, "want", lambda a, b: F.abs(a - b))
    return made.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.array_max(gaps) < 1e-6).alias("n_as_expected"))


@query
def bad_vectors(spark, sf_dir):
    """Vectors that lost a part, or are missing."""
    vectors = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") == 7, F.lit(None))
        .when(
            F.col("l_linenumber") == 6, array_to_vector(F.array("l_quantity", "l_extendedprice"))
        )
        .otherwise(array_to_vector(F.array("l_quantity", "l_extendedprice", "l_tax")))
        .alias("features")
    )
    return features.bad_vectors(vectors, "features", 3)


# ---- clusters around given centres -------------------------------------------------


def scaled_lineitem(spark, sf_dir) -> DataFrame:
    cols = ["l_quantity", "l_extendedprice"]
    items = table(spark, sf_dir, "lineitem").select(*fx.LINE_KEY, *cols)
    return features.standardize(items, cols, prefix="z_")


def labelled_lineitem(spark, sf_dir) -> DataFrame:
    return cluster.assign(scaled_lineitem(spark, sf_dir), fx.LINE_Z, fx.LINE_CENTERS)


def labelled_part(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part")
    scaled = features.standardize(part, ["p_size", "p_retailprice"], prefix="z_")
    return cluster.assign(scaled, ["z_p_size", "z_p_retailprice"], fx.PART_CENTERS)


@query
def assign_fixed(spark, sf_dir):
    return labelled_lineitem(spark, sf_dir).select(*fx.LINE_KEY, "cluster")


@query
def cluster_sizes(spark, sf_dir):
    return cluster.sizes(labelled_lineitem(spark, sf_dir))


@query
def cluster_sizes_in_range(spark, sf_dir):
    """Plausible rows, standardised, put to their nearest centre, and counted."""
    cols = ["l_quantity", "l_extendedprice"]
    items = table(spark, sf_dir, "lineitem").select(*cols)
    rows = clean.filter_bounds(items, fx.LINE_BOUNDS)
    scaled = features.standardize(rows, cols, prefix="z_")
    labelled = cluster.assign(scaled, fx.LINE_Z, fx.LINE_CENTERS)
    return rounded(cluster.profile(labelled, cols), [f"avg_{c}" for c in cols])


@query
def cluster_rows(spark, sf_dir):
    return labelled_part(spark, sf_dir).where(F.col("cluster") == 1).select("p_partkey", "p_brand")


@query
def cluster_profile(spark, sf_dir):
    cols = ["p_size", "p_retailprice"]
    return rounded(
        cluster.profile(labelled_part(spark, sf_dir), cols), [f"avg_{c}" for c in cols]
    )


@query
def cluster_examples(spark, sf_dir):
    found = cluster.examples(labelled_part(spark, sf_dir), ["p_partkey", "p_name", "p_brand"])
    return found.drop("place")


@query
def lloyd_step(spark, sf_dir):
    step = cluster.lloyd_step(scaled_lineitem(spark, sf_dir), fx.LINE_Z, fx.LINE_CENTERS)
    return rounded(step, fx.LINE_Z)


@query
def silhouette_fixed(spark, sf_dir):
    labelled = labelled_lineitem(spark, sf_dir)
    found = cluster.silhouette(labelled, fx.LINE_Z, k=len(fx.LINE_CENTERS))
    return rounded(found, ["silhouette"])


@query
def best_k_fixed(spark, sf_dir):
    """The best of three sets of given centres by silhouette."""
    scaled = scaled_lineitem(spark, sf_dir).select(*fx.LINE_Z)
    found = cluster.silhouettes(scaled, fx.LINE_Z, fx.CENTER_SETS)
    scores = spark.createDataFrame(list(found.items()), cluster.SWEEP_SCHEMA)
    return cluster.best_k(rounded(scores, ["silhouette"]))


# ---- k-means -----------------------------------------------------------------------


def training_rows(spark, sf_dir) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(*fx.LINE_KEY, *fx.LINE_FEATURES)
    gap = F.when(F.col("l_linenumber") != 7, F.col("l_tax"))
    return items.withColumn("l_tax", gap)


def _train(spark, sf_dir, **training) -> tuple[DataFrame, cluster.Trained]:
    rows = training_rows(spark, sf_dir)
    wide = spark.sparkContext.defaultParallelism
    return rows, cluster.train(
        rows, fx.LINE_FEATURES, partitions=wide, **training
    )


#: Bytes of a method that the JVM compiles at most; beyond, Spark splits the expressions instead of running them uncompiled.
COMPILED = "8000"


def _sweep_holds(trained: cluster.Trained, within: float) -> DataFrame:
    """What every right sweep over all rows fulfils, with labels, costs and scores worked out again.

    Per k the rows in the last iteration's clusters and those labelled anew, whether the final
    centres cost no more than those they come from, whether the score is ``within`` that of all
    rows by the single-k silhouette, and whether exactly the best score is marked.
    """
    points, fits, told = trained.points, trained.sweep.fits.by_k, trained.sweep.silhouettes
    names = [c for c in points.columns if c.startswith("f")]
    best = max(fits, key=lambda k: (told[k], -k))

    def judge(k: int) -> tuple:
        fit = fits[k]
        near = cluster.assign(points, names, fit.centers)
        least = F.array_min(F.array(*[cluster.squared_distance(names, c) for c in fit.centers]))
        rows = F.col(cluster.WEIGHT)
        found = near.agg(F.sum(least * rows).alias("cost"), F.sum(F.when(F.col("cluster").isNotNull(), rows)).alias("n")).first()
        again = cluster.silhouette(near, names, len(fit.centers), weight=cluster.WEIGHT).first()["silhouette"]
        falls = found["cost"] <= fit.cost * (1 + 1e-9)
        return k, sum(fit.sizes), found["n"], falls, abs(told[k] - again) < within, (k == trained.sweep.best) == (k == best)

    # A few short jobs for each k; side by side they fill the cluster. Code of many centres is split.
    with scratch.setting(points.sparkSession, "spark.sql.codegen.hugeMethodLimit", COMPILED), ThreadPool(len(fits)) as pool:
        rows = pool.map(inheritable_thread_target(points.sparkSession)(judge), list(fits), chunksize=1)
    schema = "k bigint, n_fitted bigint, n_rows bigint, cost_falls boolean, same_score boolean, best_is_marked boolean"
    return points.sparkSession.createDataFrame(rows, schema)


@query
def kmeans_sweep(spark, sf_dir):
    """The whole sweep: every k from 3 to 10 fitted and scored on all rows."""
    return _sweep_holds(_train(spark, sf_dir, **presets.FULL_SWEEP)[1], 1e-9)


@query
def kmeans_fast(spark, sf_dir):
    """Bounded iterations, scored on a Bernoulli sample."""
    return _sweep_holds(_train(spark, sf_dir, **presets.FAST_SWEEP)[1], 0.05)


def _labels_hold(labelled: DataFrame, points, label: str) -> DataFrame:
    """How many rows there are, how many carry the label of a nearest centre, and how many labels occur.

    ``labelled`` has the vectors that were compared with the centres ``points``.
    """
    parts = vector_to_array("features")
    names = [f"z{i}" for i in range(len(points[0]))]
    made = labelled.select(F.col(label).alias("own"), *[parts[i].alias(n) for i, n in enumerate(names)])
    made = made.withColumn("d", F.array(*[cluster.squared_distance(names, p) for p in points]))
    return made.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.get("d", F.col("own")) <= F.array_min("d") + 1e-9).alias("n_nearest"),
        (F.count_distinct("own") == len(points)).alias("all_labels_occur"),
    )


@query
def kmeans_train(spark, sf_dir):
    """Labels of all rows from the model that the whole sweep chose, gaps imputed."""
    rows, trained = _train(spark, sf_dir, **presets.FULL_SWEEP)
    points = cluster.kmeans_stage(trained.model).clusterCenters()
    return _labels_hold(trained.model.transform(rows), points, "prediction")


@query
def kmeans_refit(spark, sf_dir):
    """Labels after fitting preparation and clustering again on the raw rows."""
    rows, trained = _train(spark, sf_dir, **presets.FAST_SWEEP, refit=True)
    points = cluster.kmeans_stage(trained.model).clusterCenters()
    return _labels_hold(trained.model.transform(rows), points, "prediction")


@query
def kmeans_seeds(spark, sf_dir):
    """Starting centres of part for three and five clusters, drawn by the key."""
    scaled = features.standardize(table(spark, sf_dir, "part"), ["p_size", "p_retailprice"], prefix="z_")
    found = lloyd.seeds(scaled, ["z_p_size", "z_p_retailprice"], [3, 5], key=["p_partkey"])
    rows = [(k, c, *map(float, at)) for k, points in found.items() for c, at in enumerate(points)]
    return rounded(spark.createDataFrame(rows, "k int, c int, x double, y double"), ["x", "y"])


@query
def lloyd_joint(spark, sf_dir):
    """Three sets of centres after three joint iterations, with the sizes and costs of the last one."""
    scaled = scratch.materialize(scaled_lineitem(spark, sf_dir).select(*fx.LINE_Z), "scaled")
    fits = lloyd.iterate(scaled, fx.LINE_Z, fx.CENTER_SETS, max_iter=fx.JOINT_ITERATIONS, tol=0.0)
    rows = [
        (k, c, fit.sizes[c], float(fit.cost), *map(float, at)) for k, fit in fits.by_k.items() for c, at in enumerate(fit.centers)
    ]
    return rounded(spark.createDataFrame(rows, "k int, c int, n bigint, cost double, x double, y double"), ["cost", "x", "y"], 3)


@query
def kmeans_centers(spark, sf_dir):
    """Whether the centres are finite and inside the ranges of the scaled columns."""
    rows, trained = _train(spark, sf_dir, ks=[3], max_iter=20, tol=1e-3)
    parts = vector_to_array("features")
    names = fx.LINE_FEATURES
    ends = trained.model.transform(rows).agg(
        *[f(parts[i]).alias(f"{n}{i}") for i in range(len(names)) for n, f in (("lo", F.min), ("hi", F.max))]
    ).first()
    inside = [F.col(c).between(ends[f"lo{i}"], ends[f"hi{i}"]) for i, c in enumerate(names)]
    found = cluster.centers(spark, trained.model, names)
    return found.select(F.col("cluster").cast("bigint").alias("cluster"), reduce(and_, inside).alias("inside"))


@query
def kmeans_labels_nearest(spark, sf_dir):
    """How many rows there are, and how many carry the label of a nearest centre."""
    rows, trained = _train(spark, sf_dir, ks=[4], max_iter=20, tol=1e-3)
    points = cluster.kmeans_stage(trained.model).clusterCenters()
    parts = vector_to_array("features")
    names = [f"z{i}" for i in range(len(fx.LINE_FEATURES))]
    made = trained.model.transform(rows).select(
        "prediction", *[parts[i].alias(n) for i, n in enumerate(names)]
    )
    gaps = [
        cluster.squared_distance(names, p).alias(f"d{i}") for i, p in enumerate(points)
    ]
    far = made.select("prediction", *gaps)
    own = F.coalesce(
        *[F.when(F.col("prediction") == i, F.col(f"d{i}")) for i in range(len(points))]
    )
    least = F.least(*[F.col(f"d{i}") for i in range(len(points))])
    return far.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(own <= least + 1e-9).alias("n_nearest")
    )


@query
def model_roundtrip_score(spark, sf_dir):
    """Labels of the whole reloaded model against those of the fitted one, from the raw rows."""
    rows, trained = _train(spark, sf_dir, ks=[3], max_iter=20, tol=1e-3)
    path = cluster.save_model(trained.model, scratch.folder(spark, "model"))
    # The first model fills gaps in place; the second one gets the raw values back.
    kept = rows.withColumn("raw", F.struct(*fx.LINE_FEATURES))
    first = trained.model.transform(kept).select("raw.*", F.col("prediction").alias("first"))
    both = cluster.load_model(spark, path).transform(first)
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("first") == F.col("prediction")).alias("n_same")
    )


@query
def saved_model_scores(spark, sf_dir):
    """Batch scoring from the model directory that the report names."""
    rows, trained = _train(spark, sf_dir, **presets.FAST_SWEEP)
    path = cluster.save_model(trained.model, scratch.folder(spark, "model"))
    report = sinks.write_report(
        trained.sweep.scores, scratch.folder(spark, "report"), {trained.sweep.best: path}
    )
    best = sinks.best_model_path(spark, report)
    scored = cluster.score(rows, best, keep=fx.LINE_FEATURES)
    # The vectors of the kept columns, by the model's own preparation.
    prepared = PipelineModel(stages=cluster.load_model(spark, best).stages[:-1]).transform(scored)
    points = [tuple(c) for c in trained.sweep.fits.by_k[trained.sweep.best].centers]
    kept = cluster.kmeans_stage(cluster.load_model(spark, best)).clusterCenters()
    if sorted(map(tuple, kept)) != sorted(points):
        raise ValueError("the report names a model with other centres than those of the best k")
    return _labels_hold(prepared, kept, "cluster")


@query
def sweep_report(spark, sf_dir):
    """The report as it is read back: one row per k, with the best k of the sweep."""
    trained = _train(spark, sf_dir, **presets.FAST_SWEEP)[1]
    path = sinks.write_report(trained.sweep.scores, scratch.folder(spark, "report"))
    read = sources.read_jsonl(spark, path).select(F.col("best.k").alias("best"), F.inline("sweep"))
    told = F.create_map(*[F.lit(x) for pair in trained.sweep.silhouettes.items() for x in pair])
    return read.select(
        F.col("k").cast("bigint").alias("k"),
        (F.col("best") == trained.sweep.best).alias("names_the_best"),
        (F.abs(F.col("silhouette") - F.get(F.map_values(F.map_filter(told, lambda k, v: k == F.col("k"))), F.lit(0))) < 1e-9).alias("same_score"),
    )
