"""The corpus pipeline: toxicity, near-duplicates, repeated passages, benchmark leaks, packing.

Each stage takes what the one before kept and returns the columns of the documents, the last one
the packed pieces. Null texts are empty documents; they pass until they are packed with size 0.
A row without an id passes the second and fourth stage, which name documents by id; in the third
its id is larger than all others. Rows of one id go or stay together there. Other columns are
carried along whatever their names and values; ``n_chars``, where there is one, follows the text.
Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill import scratch
from gristmill.functions.names import quoted
from gristmill.llm import decontaminate, neardup, packing, substrings, toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name = f"_{name}"
    return name


def _columns(docs: DataFrame) -> list:
    return [F.col(quoted(c)) for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half; the model learns from all labels."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = _free(docs, "toxicity_score")
    return toxicity.score(docs, model, out=out).where(F.col(out) < 0.5).select(*_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates, that with the smallest id."""
    gone = neardup.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*_columns(docs))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that a document with a smaller id has; emptied documents go."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    bare = docs.select("doc_id", "text", F.struct(*[F.col(quoted(c)) for c in rest]).alias("rest")) if rest else docs
    cut = substrings.remove_repeats(bare, keep=("rest",) if rest else (), gaps=True)
    left = cut.where("n_removed = 0 or n_removed < n_words")

    def column(c: str):
        if c == "text":
            return F.col("kept").alias(c)
        if c == "n_chars":
            return F.length("kept").cast(docs.schema[c].dataType).alias(c)
        return F.col("doc_id") if c == "doc_id" else F.col("rest")[c].alias(c)

    return left.select(*[column(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    gone = decontaminate.contamination(docs, items).where("contaminated").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*_columns(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their bins: no bin has two documents of a source or with equal texts."""
    sized = docs.select("doc_id", "source", packing.word_count(F.col("text")).alias("n_words"), F.xxhash64("text").alias("cluster"), F.monotonically_increasing_id().alias("row"))
    return packing.pack(scratch.materialize(sized, "sizes"), "n_words", row="row")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Scores of a trained model and a greedy order of bins are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage is written and read again by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
