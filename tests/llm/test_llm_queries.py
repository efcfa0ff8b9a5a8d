"""Registered queries against SQL where SQL can say it, else against brute force."""

import math
import re
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from gristmill.llm import queries

duckdb = pytest.importorskip("duckdb")
TABLES = ("documents", "pages", "benchmark", "labels", "embeddings")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def engine(data):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(engine):
    return dict(engine.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, data, engine, name):
    df = queries.QUERIES[name](spark, data)
    found = engine.execute(queries.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    got = sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
    assert got == sorted((tuple(r) for r in found.fetchall()), key=repr)


def test_token_counts_equal_the_library(spark, data, texts):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in queries.op2_token_counts(spark, data).collect():
        n = len(model.encode(texts[r["doc_id"]] or ""))
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 4096)
        assert r["n_bytes"] == len((texts[r["doc_id"]] or "").encode())


def test_urls_follow_rules(spark, data, engine):
    urls = dict(engine.execute("SELECT page_id, url FROM pages").fetchall())
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
    rows = queries.op3_url_filters(spark, data).collect()
    assert len(rows) == len(urls)
    for r in rows:
        rest = urls[r["page_id"]].partition("://")[2]
        host = re.split("[/?#]", rest, maxsplit=1)[0].translate(LOWER)
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r["host"], r["path"]) == (host, path)
        assert r["rule"] == (max(fits)[1] if fits else None)
        assert r["verdict"] == max(fits)[2] if fits else r["verdict"] in ("allow", "block")


def test_toxicity_on_held_out_labels(spark, engine):
    folder = "/root/testdata/sf0.01"
    truth = dict(duckdb.execute(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall())
    rows = queries.op4_toxicity(spark, folder).collect()
    assert len(rows) == 1000
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.9


def test_quality_counts(spark, data, texts):
    for r in queries.op6_quality_rules(spark, data).collect():
        text = texts[r["doc_id"]] or ""
        w = SPACED.findall(text)
        lines = [x for x in text.split("\n") if SPACED.search(x)]
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        often = Counter(windows)
        covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        assert tuple(r)[1:7] == (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed)
        assert not (r["kept"] and failed)


def test_language_model_base(spark, data, texts):
    tokens = {i: [*SPACED.findall((t or "").translate(LOWER)), "\n"] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    count = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    total, distinct = sum(count.values()), len(count)
    rows = queries.op8_lm_scoring(spark, data).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ws = tokens[r["doc_id"]]
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(ws), total)
        assert r["n_known"] == sum(w in count for w in ws)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] < 0


def check_packing(rows, sizes, sources, texts, capacity=1024):
    """Every piece once, no overlap, no shared source or text in a bin."""
    whole, bins = Counter(), {}
    for r in rows:
        whole[r["doc_id"]] += r["size"]
        bins.setdefault(r["bin_id"], []).append(r)
    assert whole == Counter(sizes)
    for held in bins.values():
        end = 0
        for r in sorted(held, key=lambda r: (r["bin_offset"], r["size"])):
            assert r["bin_offset"] == end
            end += r["size"]
        assert end <= capacity
        assert len({sources[r["doc_id"]] for r in held}) == len(held)
        assert len({texts[r["doc_id"]] for r in held}) == len(held)


def test_packing_keeps_all_and_separates(spark, data, engine, texts):
    sources = dict(engine.execute("SELECT doc_id, source FROM documents").fetchall())
    sizes = {i: len(SPACED.findall(t or "")) for i, t in texts.items()}
    check_packing(queries.op9_best_fit_packing(spark, data).collect(), sizes, sources, texts)


def test_pipeline_stages_against_brute_force(spark, data, engine, texts):
    """Each stage on its own input, by what the operators' SQL or brute force says of that input."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "substring_dedup", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r.asDict() for r in docs.collect()}
        con = duckdb.connect()
        frame = docs.toPandas()
        con.execute("CREATE TABLE documents AS SELECT * FROM frame")
        con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{data}/benchmark.parquet'")
        assert len(frame) == len(before)
        out = stage(spark, docs, data)
        if name != "packing":
            assert out.columns == docs.columns
        rows = out.collect()
        if name == "toxicity":
            assert 0 < len(rows) < len(before)
        elif name == "near_duplicates":
            said = con.execute(queries.SQL["op7_near_duplicates"]).fetchdf()
            assert {r["doc_id"] for r in rows} == set(said[said.kept].doc_id)
        elif name == "substring_dedup":
            said = con.execute(queries.SQL["op10_substring_dedup"]).fetchdf().set_index("doc_id")
            gone = {i for i in before if 0 < said.n_words[i] == said.n_removed[i]}
            assert {r["doc_id"] for r in rows} == set(before) - gone
            for r in rows:
                assert len(SPACED.findall(r["text"])) == said.n_words[r["doc_id"]] - said.n_removed[r["doc_id"]]
                assert said.n_removed[r["doc_id"]] or r["text"] == before[r["doc_id"]]["text"]
                assert r["n_chars"] == len(r["text"])
        elif name == "decontamination":
            said = con.execute(queries.SQL["op5_decontamination"]).fetchdf()
            assert {r["doc_id"] for r in rows} == set(said[~said.contaminated].doc_id)
        else:
            sizes = {i: len(SPACED.findall(r["text"] or "")) for i, r in before.items()}
            check_packing(rows, sizes, {i: r["source"] for i, r in before.items()}, {i: r["text"] for i, r in before.items()})
            return
        docs = spark.createDataFrame(rows, docs.schema)
