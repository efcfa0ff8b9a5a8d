"""Work and memory of the scored operators."""

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from gristmill import scratch
from gristmill.llm import suffix_tree, toxicity


def test_the_fit_has_no_more_tasks_than_cores(spark, monkeypatch):
    words = F.when(F.col("doc_id") % 2 == 0, F.lit("awful rotten")).otherwise(F.lit("kind gentle"))
    text = F.concat_ws(" ", words, F.col("doc_id").cast("string"), F.repeat(F.lit("plain words "), 20))
    docs = scratch.materialize(spark.range(400).withColumnRenamed("id", "doc_id").select("doc_id", text.alias("text")).repartition(40), "docs")
    labels = docs.select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("toxic"))
    parts, fit = [], LogisticRegression.fit
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, df, *a: parts.append(df.rdd.getNumPartitions()) or fit(self, df, *a))
    with scratch.setting(spark, "spark.sql.files.maxPartitionBytes", "2k"), scratch.setting(spark, "spark.sql.files.openCostInBytes", "1k"):
        model = toxicity.fit(docs, labels)
    assert parts and parts[0] <= spark.sparkContext.defaultParallelism
    score = model.scorer()
    assert score([b"awful", b"rotten"]) > 0.5 > score([b"kind", b"gentle"])


def test_asking_works_out_no_probabilities(spark, monkeypatch):
    climb = suffix_tree.climb

    def watched(units, read, *a, **named):
        def seen(row, scored):
            out = read(row, scored)
            sent = [b["k"] for b in row["back"]]
            if (out[-1] is None) == scored or any((k is None) == scored for k in sent):
                raise ValueError("probabilities are for the rows that are scored")
            return out

        return climb(units, seen, *a, **named)

    monkeypatch.setattr(suffix_tree, "climb", watched)
    docs = spark.createDataFrame([(i, "a b c a b c a b d" if i % 3 else None) for i in range(30)], "doc_id long, text string")
    rows = suffix_tree.scores(docs, F.col("doc_id") % 10 != 0, least=2).collect()
    assert len(rows) == 30 and all(r["score"] < 0 for r in rows)


def test_hashes_are_of_distinct_words(spark, monkeypatch):
    climb = suffix_tree.climb

    def watched(units, read, *a, **named):
        def seen(row, scored):
            out = read(row, scored)
            hashes, counts = out[3:5]
            if len(hashes) > 5 or len(counts) > 10:  # four words and the end; with marks, ten characters at most
                raise ValueError("hashes and counts are for symbols, not for positions")
            return out

        return climb(units, seen, *a, **named)

    monkeypatch.setattr(suffix_tree, "climb", watched)
    docs = spark.createDataFrame([(i, "a b c a b c a b d " * 20) for i in range(10)], "doc_id long, text string")
    rows = suffix_tree.scores(docs, F.col("doc_id") != 0, least=2).collect()
    assert len(rows) == 10 and len({round(r["score"], 6) for r in rows}) == 1
