"""Imputation, standardisation and feature vectors."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions import quoted

# For exact medians the range around the middle is narrowed, until at most about this many
# distinct values per column are left for a sorted window.
MEDIAN_WINDOW = 50_000
MEDIAN_SAMPLE = 1_000_000
# Size parameter of the quantile sketches. By the published bound (2.296 / k^0.9021) the ranks of
# 99 in 100 sketches are off by less than 0.00037; the promised bound is 2.7 times that.
SKETCH_K = 16_384
RANK_ERROR = 0.001


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``column, mean, stddev`` (sample deviation), one scan for all columns."""
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.avg(F.col(quoted(c))).alias("mean"),
            F.stddev_samp(F.col(quoted(c))).alias("stddev"),
        )
        for c in cols
    ]
    return df.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))


def standardize(
    df: DataFrame,
    cols: Sequence[str],
    prefix: str = "",
    fitted: DataFrame | None = None,
) -> DataFrame:
    """``(x - mean) / stddev`` per column; a constant column becomes 0, null stays null.

    The moments of ``df``, or those ``fitted`` on another table, are 2 x d numbers that
    the driver reads and puts into the projection as literals: nothing is joined.
    ``prefix=""`` replaces the columns, any other prefix adds new ones.
    """
    known = moments(df, cols) if fitted is None else fitted
    rows = {r["column"]: r for r in known.collect()}
    scaled = {}
    for c in cols:
        value = F.col(quoted(c)).cast("double")
        mean, spread = rows[c]["mean"], rows[c]["stddev"]
        if mean is None:
            scaled[prefix + c] = F.lit(None).cast("double")
        elif not spread:
            scaled[prefix + c] = (value - F.lit(mean)) * 0.0
        else:
            scaled[prefix + c] = (value - F.lit(mean)) / F.lit(spread)
    return df.withColumns(scaled)


def medians(
    df: DataFrame,
    cols: Sequence[str],
    exact: bool = False,
    window: int = MEDIAN_WINDOW,
    sample: int = MEDIAN_SAMPLE,
) -> DataFrame:
    """``column, median`` over the values that are neither null nor NaN.

    The default reads them off the sketches of ``quantile_sketches``, one job; the rank of a
    median is then within ``RANK_ERROR`` of the middle. ``exact=True`` gives the true median
    (mean of the two middle values) by the same search at every size; it scans ``df`` several
    times, so give it a table on storage. A column without values has a null median.
    """
    cols = list(cols)
    values = df.select(*[_number(c).alias(f"v{i}") for i, c in enumerate(cols)])
    if not exact:
        return sketched_quantiles(quantile_sketches(df, cols), [0.5]).select("column", F.col("value").alias("median"))
    counts = values.agg(*[F.count(f"v{i}") for i in range(len(cols))]).first()
    ranges = _median_ranges(values, list(counts), window, sample)
    return _finish_medians(values, cols, ranges)


def quantile_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by.., column, n, sketch``: a quantile sketch of every column, in one scan, per slice if ``by`` names any.

    A sketch is a few hundred kilobytes at most, whatever the number of rows. Store the table: sketches of
    slices merge to that of the union (``merge_sketches``) without a look at the rows, so a new
    slice costs only itself. Null and NaN are left out.
    """
    groups = [F.col(quoted(c)) for c in by]
    values = df.select(*groups, *[_number(c).alias(f"_v{i}") for i, c in enumerate(cols)])
    rows = [
        F.struct(F.lit(c).alias("column"), F.count(f"_v{i}").alias("n"), F.kll_sketch_agg_double(f"_v{i}", SKETCH_K).alias("sketch"))
        for i, c in enumerate(cols)
    ]
    return values.groupBy(*groups).agg(F.array(*rows).alias("_rows")).select(*groups, F.inline("_rows"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by.., column, n, sketch`` of the union of all slices that have the same ``by``."""
    groups = [F.col(quoted(c)) for c in by]
    held = F.when(F.col("n") > 0, F.col("sketch"))
    return sketches.groupBy(*groups, "column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double(held).alias("sketch"))


def sketched_quantiles(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``.., column, share, value``: a value whose rank is within ``RANK_ERROR`` of each share.

    Null where there are no values.
    """
    kept = [c for c in sketches.columns if c not in ("n", "sketch")]
    each = F.array(
        *[
            F.struct(F.lit(float(s)).alias("share"), F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(s)))).alias("value"))
            for s in shares
        ]
    )
    return sketches.select(*[quoted(c) for c in kept], F.inline(each))


def _number(name: str):
    value = F.col(quoted(name)).cast("double")
    return F.when(~F.isnan(value), value)


def _median_ranges(
    values: DataFrame, counts: list[int], window: int, sample: int
) -> list[dict]:
    """Per column a closed value range that surely holds the middle values.

    A seeded sample proposes a narrow range, an exact count checks it. Every round is
    two scans without a shuffle and brings a few numbers per column to the driver. The
    range shrinks to under a percent of its rows per round, whatever the distribution.
    Repeated values do not matter, since the size that counts is the number of distinct
    values: often the range is a single value, which then is the median.
    """
    reach = min(0.25, 4.0 / math.sqrt(sample))
    ranges = [
        {
            "lo": -math.inf,
            "hi": math.inf,
            "below": 0,
            "inside": n,
            "distinct": n,
            "first": (n - 1) // 2,
            "second": n // 2,
            "reach": reach,
        }
        for n in counts
    ]
    seed = 0
    while wide := [i for i, r in enumerate(ranges) if r["distinct"] > window]:
        seed += 1
        proposals = _propose(values, ranges, wide, sample, seed)
        measures = []
        for i, (lo, hi) in proposals.items():
            v = F.col(f"v{i}")
            inside = v.between(F.lit(lo), F.lit(hi))
            measures += [
                F.count_if(v < F.lit(lo)).alias(f"b{i}"),
                F.count_if(inside).alias(f"n{i}"),
                F.count_if(v == F.lit(lo)).alias(f"l{i}"),
                F.count_if(v == F.lit(hi)).alias(f"h{i}"),
                F.approx_count_distinct(F.when(inside, v)).alias(f"u{i}"),
            ]
        found = values.agg(*measures).first()
        for i, (lo, hi) in proposals.items():
            r, below, inside = ranges[i], found[f"b{i}"], found[f"n{i}"]
            if not below <= r["first"] <= r["second"] < below + inside:
                r["reach"] *= 2
                continue
            at_lo, at_hi, distinct = found[f"l{i}"], found[f"h{i}"], found[f"u{i}"]
            if r["second"] < below + at_lo:
                hi, inside = lo, at_lo
            elif r["first"] >= below + inside - at_hi:
                lo, below, inside = hi, below + inside - at_hi, at_hi
            distinct = 1 if lo == hi else distinct
            r.update(lo=lo, hi=hi, below=below, inside=inside, distinct=distinct, reach=reach)
    return ranges


def _propose(values, ranges, wide, sample, seed) -> dict[int, tuple[float, float]]:
    """Sample quantiles just below and above the middle of each too wide range."""
    share = {i: min(1.0, sample / ranges[i]["inside"]) for i in wide}
    most = max(share.values())
    drawn = values.sample(False, most, seed).withColumn("draw", F.rand(seed) * most)
    quantiles = []
    for i in wide:
        r, v = ranges[i], F.col(f"v{i}")
        middle = [(r[end] - r["below"]) / max(1, r["inside"] - 1) for end in ("first", "second")]
        ends = [max(0.0, middle[0] - r["reach"]), min(1.0, middle[1] + r["reach"])]
        taken = v.between(F.lit(r["lo"]), F.lit(r["hi"])) & (F.col("draw") < F.lit(share[i]))
        quantiles.append(F.percentile_approx(F.when(taken, v), ends, 10_000).alias(f"q{i}"))
    row = drawn.agg(*quantiles).first()
    # An empty draw proposes nothing narrower.
    return {i: tuple(row[f"q{i}"] or (ranges[i]["lo"], ranges[i]["hi"])) for i in wide}


def _finish_medians(values: DataFrame, cols: list[str], ranges: list[dict]) -> DataFrame:
    """Count each candidate value, then read the middle ranks off the running counts."""
    spark = values.sparkSession
    known = {i: r["lo"] for i, r in enumerate(ranges) if r["lo"] == r["hi"]}
    names = spark.createDataFrame(
        [(i, c, known.get(i)) for i, c in enumerate(cols)], "i int, column string, known double"
    )
    open_ranges = {i: r for i, r in enumerate(ranges) if i not in known and r["inside"] > 0}
    if not open_ranges:
        return names.select("column", F.col("known").alias("median"))

    inside = {
        i: F.col(f"v{i}").between(F.lit(r["lo"]), F.lit(r["hi"])) for i, r in open_ranges.items()
    }
    candidates = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.when(holds, F.col(f"v{i}")).alias("value"))
            for i, holds in inside.items()
        ]
    )
    counted = (
        values.where(reduce(or_, inside.values()))
        .select(F.inline(candidates))
        .where(F.col("value").isNotNull())
        .groupBy("i", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = F.sum("n").over(Window.partitionBy("i").orderBy("value"))
    place = counted.select("i", "value", (upto - F.col("n")).alias("start"), upto.alias("end"))

    def at(end):
        rank = F.coalesce(
            *[F.when(F.col("i") == i, F.lit(r[end] - r["below"])) for i, r in open_ranges.items()]
        )
        return F.max(F.when((F.col("start") <= rank) & (rank < F.col("end")), F.col("value")))

    found = place.groupBy("i").agg(((at("first") + at("second")) / 2).alias("median"))
    # One row per column, also for a column without any value.
    return names.join(found, "i", "left").select(
        "column", F.coalesce("known", "median").alias("median")
    )


def impute(
    df: DataFrame,
    cols: Sequence[str],
    fill: Mapping[str, float] | None = None,
    exact: bool = False,
) -> DataFrame:
    """Put the column median (or the given value) in place of null and NaN."""
    if fill is None:
        fill = {r["column"]: r["median"] for r in medians(df, cols, exact=exact).collect()}
    empty = [c for c in cols if fill.get(c) is None]
    if empty:
        raise ValueError(f"no value to impute for {empty}: the columns hold no numbers")
    return df.withColumns({c: F.coalesce(_number(c), F.lit(float(fill[c]))) for c in cols})


def assemble(
    df: DataFrame, cols: Sequence[str], output: str = "features", invalid: str = "error"
) -> DataFrame:
    """Add a vector column; ``invalid="skip"`` drops rows with a null or NaN part."""
    return VectorAssembler(
        inputCols=list(cols), outputCol=output, handleInvalid=invalid
    ).transform(df)


def bad_vectors(df: DataFrame, vector: str, size: int) -> DataFrame:
    """One row ``n_bad``: vectors that are missing or not of the given length."""
    value = F.col(quoted(vector))
    # A missing vector cannot be unpacked, hence the branch.
    wrong = F.when(value.isNull(), True).otherwise(F.size(vector_to_array(value)) != size)
    return df.agg(F.count_if(wrong).alias("n_bad"))


def stages(
    cols: Sequence[str],
    impute_nulls: bool = True,
    invalid: str = "error",
    output: str = "features",
) -> list:
    """Unfitted ML stages impute -> assemble -> standardise, for ``pyspark.ml.Pipeline``.

    Medians replace nulls in place; without imputing, ``invalid="skip"`` drops the
    incomplete rows instead.
    """
    cols = list(cols)
    raw = f"{output}_raw"
    chain = []
    if impute_nulls:
        chain.append(Imputer(strategy="median", inputCols=cols, outputCols=cols))
    chain.append(VectorAssembler(inputCols=cols, outputCol=raw, handleInvalid=invalid))
    chain.append(StandardScaler(withMean=True, withStd=True, inputCol=raw, outputCol=output))
    return chain
