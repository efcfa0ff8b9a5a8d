"""Toxicity scores: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text is the set of the hashed character n-grams of its padded, lower-cased words. The log ratio
of a feature's share in the two classes scales its column; an L1-penalised logistic regression on
the scaled columns then picks the weights. Fitting reads a sample of labelled rows bounded by
``PER_CLASS``; scoring reads every whole text once, without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill import scratch
from gristmill.functions.names import quoted
from gristmill.llm.blocks import spaced_lower, spans, texts_of

DIMS = 1 << 18
SIZES = (3, 4, 5, 6)
#: Labelled rows of each class that are used for fitting, at most: those with the smallest hashed ids.
PER_CLASS = 4000
#: Features in fewer sampled documents, or with a smaller log ratio either way, carry no weight.
MIN_DOCS = 5
MIN_RATIO = 0.7
PENALTY = 3e-3
#: Words whose features a task keeps, as tuples of a few numbers; when fitting, a tenth of it, as packed numbers.
CACHED = 300_000
BATCH_BYTES = 4 << 20


def word_features(word: bytes) -> set[int]:
    """Hashed n-grams of a word between spaces."""
    padded = f" {word.decode('utf-8', 'replace')} "
    return {
        zlib.crc32(padded[i : i + n].encode()) & (DIMS - 1)
        for n in SIZES
        for i in range(max(1, len(padded) - n + 1))
    }


@dataclass(frozen=True)
class Model:
    """Feature numbers with a weight other than 0, their weights (ratios included), and the intercept."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float

    def scorer(self):
        """A function from the words of a text to its score."""
        weight = dict(zip(self.features.tolist(), self.weights.tolist(), strict=True))
        # Most words have no feature that counts, so what is kept is small.
        known: dict[bytes, tuple[int, ...]] = {}

        def score(words: list[bytes]) -> float:
            if len(known) > CACHED:
                known.clear()
            found: set[int] = set()
            for w in set(words):
                own = known.get(w)
                if own is None:
                    own = known[w] = tuple(f for f in word_features(w) if f in weight)
                if own:
                    found.update(own)
            return float(1 / (1 + np.exp(-(self.intercept + sum(weight[f] for f in sorted(found))))))

        return score


def sample_labels(labels: DataFrame, key: str, label: str, per_class: int = PER_CLASS) -> DataFrame:
    """``per_class`` rows of each class at most, those with the smallest hashed keys, as ``k``, ``y``, ``weight``.

    Weights restore the share of the classes. Null keys and labels are left out; repeated keys count once.
    """
    plain = labels.select(F.col(quoted(key)).alias("k"), F.col(quoted(label)).cast("int").alias("y"))
    plain = plain.where("k is not null and y in (0, 1)").dropDuplicates(["k"])
    parts = [plain.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(per_class) for y in (0, 1)]
    sizes = {r["y"]: r["n"] for r in plain.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {y: max(1.0, n / per_class) for y, n in sizes.items()}
    weight = F.when(F.col("y") == 1, share.get(1, 1.0)).otherwise(share.get(0, 1.0))
    return parts[0].unionByName(parts[1]).withColumn("weight", weight)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """Fit on the documents that the sampled labels name; without both classes, a model that scores the prior.

    The sample has ``2 * per_class`` rows at most, so it is broadcast to the scan of the documents.
    """
    sample = scratch.materialize(sample_labels(labels, key, label, per_class), "labels")
    rows = docs.select(F.col(quoted(key)).alias("k"), F.col(quoted(text)).alias("text"))
    chosen = rows.join(F.broadcast(sample), "k").select("y", "weight", "text")

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bytes] = {}
        for batch in batches:
            raw, sizes = texts_of(batch)
            for low, high in spans(sizes, BATCH_BYTES):
                sets = []
                for t in raw.slice(low, high - low).to_pylist():
                    if len(known) > CACHED // 10:
                        known.clear()
                    own = np.zeros(DIMS, bool)
                    for w in set(spaced_lower(t)):
                        if w not in known:
                            known[w] = np.fromiter(word_features(w), np.int32).tobytes()
                        own[np.frombuffer(known[w], np.int32)] = True
                    sets.append(np.flatnonzero(own).astype(np.int32))
                cut = batch.slice(low, high - low)
                ends = np.cumsum([0, *map(len, sets)])
                f = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([cut.column(0), cut.column(1), f], names=["y", "weight", "f"])

    data = scratch.materialize(chosen.mapInArrow(featurize, "y int, weight double, f array<int>"), "features")
    totals = {r["y"]: r for r in data.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")).collect()}
    if len(totals) < 2:
        w1, w0 = (totals[y]["w"] if y in totals else 0.0 for y in (1, 0))
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log((w1 + 1) / (w0 + 1))))
    # At most DIMS rows, whatever the input.
    counts = data.select("y", F.explode("f").alias("f")).groupBy("f").agg(F.sum("y").alias("p"), F.count(F.lit(1)).alias("n"))
    held = counts.where(F.col("n") >= MIN_DOCS).toPandas()
    feature = held["f"].to_numpy(np.int64)
    p = 1.0 + held["p"].to_numpy(float)
    q = 1.0 + held["n"].to_numpy(float) - held["p"].to_numpy(float)
    ratio = np.zeros(DIMS)
    ratio[feature] = np.log(p / (totals[1]["n"] + 2)) - np.log(q / (totals[0]["n"] + 2))
    ratio[np.abs(ratio) < MIN_RATIO] = 0

    # Only scaled columns are left in the vectors, numbered anew.
    column = np.flatnonzero(ratio)
    number = np.full(DIMS, -1, np.int32)
    number[column] = np.arange(len(column))

    @F.udf(VectorUDT())
    def scaled(f):
        at = np.asarray(f, np.int64)
        at = at[number[at] >= 0]
        return Vectors.sparse(max(1, len(column)), number[at], ratio[at])

    lr = LogisticRegression(labelCol="y", weightCol="weight", standardization=False, elasticNetParam=1.0, regParam=PENALTY, maxIter=60)
    # A bounded sample: tasks beyond the cores only add a vector of sums each to every iteration.
    few = data.coalesce(data.sparkSession.sparkContext.defaultParallelism)
    fitted = lr.fit(few.select(F.col("y").cast("double"), "weight", scaled("f").alias("features")))
    weights = fitted.coefficients.toArray()[: len(column)] * ratio[column]
    at = np.flatnonzero(weights)
    return Model(column[at], weights[at], float(fitted.intercept))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 in column ``out`` for every row; null text counts as empty."""

    @F.arrow_udf("double")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = model.scorer()
        for column in batches:
            raw, sizes = texts_of(pa.RecordBatch.from_arrays([column], names=["t"]))
            scores: list[float] = []
            for low, high in spans(sizes, BATCH_BYTES):
                scores += [of(spaced_lower(t)) for t in raw.slice(low, high - low).to_pylist()]
            yield pa.array(scores, pa.float64())

    return docs.withColumn(out, judge(F.col(quoted(text))))
