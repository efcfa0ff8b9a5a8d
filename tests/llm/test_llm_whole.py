"""The pipeline on odd tables, windows that only their check tells apart, held-out URLs, ratios by brute force."""

import hashlib
import math

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.llm import substrings, toxicity, urls, warc
from gristmill.llm.blocks import spaced_lower

PASSAGE = " ".join(f"shared{i}" for i in range(60))
OWN = {name: " ".join(f"{name}{i}" for i in range(70)) for name in "xyz"}
# Named like columns that the stages make themselves.
CLASH = {"n_words": 3, "n_removed": 4, "kept": "?", "toxicity_score": 5.0, "rest": "r", "block": 1, "cluster": 2, "row": 8, "doc.id": "d", "met": True}


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, "a", f"{OWN['x']} {PASSAGE} end"),
        (2, "a", f"{OWN['y']} {PASSAGE} and another end of it"),
        (2, "b", f"{OWN['y']} {PASSAGE} and another end of it"),
        (3, None, None),
        (4, "b", ""),
        (5, "b", " \n\t "),
        (6, "c", " ".join(f"w{i % 900}y{i % 17}" for i in range(40_000))),
        (None, "c", f"{OWN['z']} {PASSAGE} but me"),
        (None, None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    return docs.withColumn("n_chars", F.length("text").cast("int")).withColumns({c: F.lit(v) for c, v in CLASH.items()})


def test_stages_carry_clashing_columns(spark, data, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, data)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        rows = out.collect()
        for r in rows:
            assert all(r[c] == v for c, v in CLASH.items()), name
            assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))
        docs = spark.createDataFrame(rows, docs.schema)
    texts = {}
    for r in rows:
        texts.setdefault(r["doc_id"], []).append(r["text"])
    assert texts[1] == [f"{OWN['x']} {PASSAGE} end"]
    assert set(texts[2]) == {f"{OWN['y']} and another end of it"}
    assert sorted(map(str, texts[None])) == ["", f"{OWN['z']} but me"]
    packed = corpus_pipeline.pack(spark, docs, data).collect()
    assert sum(r["size"] for r in packed) == sum(len((r["text"] or "").split()) for r in rows)


def test_stages_of_nothing(spark, data, odd):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), data).count() == 0


def test_equal_hashes_with_other_checks_are_no_repeat(spark, monkeypatch):
    """All windows get one 64-bit hash; only the check bits tell them apart."""
    honest = substrings._windows

    def colliding(row, length):
        start, nr, anchor, window, check = honest(row, length)
        return start, nr, anchor * np.uint64(0), window * np.uint64(0), check

    monkeypatch.setattr(substrings, "_windows", colliding)
    lone = " ".join(f"lone{i}" for i in range(40))
    docs = spark.createDataFrame([(1, f"x {PASSAGE}"), (2, f"{PASSAGE} y"), (3, lone)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], r["kept"]) for r in substrings.remove_repeats(docs.repartition(3)).collect()}
    assert got == {1: (0, f"x {PASSAGE}"), 2: (60, "y"), 3: (0, lone)}


def test_answers_return_in_the_order_of_entries():
    rnd = np.random.default_rng(3)
    hashes = np.sort(rnd.integers(0, 1 << 63, 1000).astype(np.uint64))
    batch = substrings._dealt(7, 13, hashes, None, np.zeros(1000, np.uint8))
    back = []
    for bucket, packed in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
        sent = np.frombuffer(packed, np.uint64)
        assert (sent % np.uint64(13) == bucket).all()
        back.append({"bucket": bucket, "bits": np.packbits(sent % np.uint64(5) == 0).tobytes()})
    assert (substrings._flags(13, hashes, back) == (hashes % np.uint64(5) == 0)).all()


def test_urls_not_in_the_table(spark):
    held = [
        ("http://www.city-library.gov/opening-hours", "allow"),
        ("https://maritimemuseum.nl/collections", "allow"),
        ("https://generalhospital.ie/departments/surgery", "allow"),
        ("https://cooking-recipes.eu/articles/bread", "allow"),
        ("http://localhistory.de/research/archives", "allow"),
        ("https://mountain-hiking.ch/help/maps", "allow"),
        ("http://super-casino-slots.biz/free-bonus-codes", "block"),
        ("http://onlinepokerbetting.ru/win/claim-now", "block"),
        ("https://cheap-viagra-pills.biz/order-online", "block"),
        ("http://xxx-nude-porn.tv/click?id=9", "block"),
        ("http://lottery-jackpot.win/claim-your-prize", "block"),
        ("http://warez-keygen.to/cracked/buy-now", "block"),
    ]
    table = {u for u, _ in urls.LABELLED_URLS}
    assert not table & {u for u, _ in held}
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(held)], "page_id long, url string")
    got = {r["page_id"]: r for r in urls.judge(pages, rules=()).collect()}
    assert all(r["rule"] is None for r in got.values())
    assert np.mean([got[i]["verdict"] == v for i, (_, v) in enumerate(held)]) >= 0.9


def test_a_very_long_url(spark):
    long = "http://museum.example/" + "a/b-" * 50_000 + "?q"
    grams = spark.range(1).select(urls.grams(F.lit("ab"), F.lit("")).alias("g")).first()["g"]
    assert sorted(grams) == sorted(["h^ab", "hab$", "h^ab$", "h^ab$", "p^$", "p^$", "p^$"])
    row = urls.judge(spark.createDataFrame([(1, long)], "page_id long, url string")).first()
    assert row["path"] == long[len("http://museum.example") : -2] and row["verdict"] in ("allow", "block")


def test_toxicity_by_brute_force(spark):
    """Scores by adding up weights; weights by the conditions of the L1 optimum on columns scaled by log-count ratios."""
    rude = ["you utter moron", "shut up fool", "what a stupid fool you are", "moron and idiot"]
    kind = ["have a nice day", "thank you so much", "what a lovely garden you have", "see you at noon"]
    rows = [(i, f"{(rude if i % 3 == 0 else kind)[i // 3 % 4]} number{i % 7}", int(i % 3 == 0)) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    sets = []
    for _, text, _ in rows:
        own = set()
        for w in set(spaced_lower(text.encode())):
            own |= toxicity.word_features(w)
        sets.append(own)
    y = np.array([r[2] for r in rows])
    weight = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    raw = np.array([model.intercept + sum(weight.get(f, 0.0) for f in own) for own in sets])
    want = 1 / (1 + np.exp(-raw))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert np.allclose([got[r[0]] for r in rows], want, atol=1e-9)
    for f, w in weight.items():
        has = np.array([f in own for own in sets])
        p, n = 1 + has[y == 1].sum(), 1 + has[y == 0].sum()
        ratio = math.log(p / (y.sum() + 2)) - math.log(n / ((1 - y).sum() + 2))
        slope = ((want - y) * has).mean() * ratio
        assert abs(ratio) >= toxicity.MIN_RATIO
        assert slope == pytest.approx(-toxicity.PENALTY * math.copysign(1, w / ratio), abs=0.3 * toxicity.PENALTY + 1e-5)


def test_a_long_payload_is_assembled_whole(spark, tmp_path):
    html = "<p>\r\n\r\nWARC/1.1\r\n € </p>" * 400_000
    pages = spark.createDataFrame([(1, "http://a/", html), (2, "http://b/", html), (3, None, None)], "page_id long, url string, html string")
    captures = warc.assemble(warc.read(spark, warc.write(pages, str(tmp_path / "long"))))
    rows = {r["id"]: r for r in captures.select(warc.field(F.col("metadata"), "key").alias("id"), "main.type", F.octet_length("main.payload").alias("n"), F.sha1("main.payload").alias("d")).collect()}
    raw = html.encode()
    assert (rows["2"]["type"], rows["2"]["n"], rows["2"]["d"]) == ("response", len(raw), hashlib.sha1(raw).hexdigest())
    assert rows["1"]["type"] == "revisit" and rows["3"]["n"] == 0
