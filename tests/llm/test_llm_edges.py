"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns; small brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.llm import bpe, components, decontaminate, neardup, packing, quality, substrings, suffix_tree, toxicity, urls, warc

LONG = " ".join(f"w{i % 700}x{i % 13}" for i in range(60_000))
# Columns named like those that operators use inside.
CLASH = {"block": 1, "key": "k", "text2": "t", "nr": 7, "score": 9.0, "kept": "?", "__counts": 1}


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, "the same ten words stand here for every one of us to read aloud again and again"),
        (2, "the same ten words stand here for every one of us to read aloud again and again"),
        (2, "the same ten words stand here for every one of us to read aloud again and again"),
        (3, None),
        (4, ""),
        (5, " \t\n "),
        (6, "one"),
        (7, LONG),
        (8, "tab\tand\x0bvertical\x0cform \u00a0 nbsp \u3000 wide \x1c sep \x85 nel \U0001f642 \x00 nul"),
        (None, "no id but some words that nobody else has written down in this little table"),
        (9, None),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(v) for c, v in CLASH.items()})


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_token_counts(spark, odd):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = bpe.count_tokens(odd, path)
    assert set(odd.columns) < set(out.columns)
    for r in out.collect():
        assert r["n_tokens"] == len(model.encode(r["text"] or ""))
    assert bpe.count_tokens(odd.limit(0), path).count() == 0
    rnd = random.Random(5)
    alphabet = " \n\t\u2581ab<s>/unk0xA\u00e9\u65e5\U0001f642eeoothe   xyz,.'\u3000\xa0"
    texts = ["".join(rnd.choices(alphabet, k=rnd.randrange(150))) for _ in range(400)] + ["a" * 3000, " " * 200, "ab" * 900, "\u65e5" * 300]
    assert bpe.Vocabulary(path).of_texts(texts, {}) == [len(x) for x in model.encode(texts)]


def test_toxicity(spark, odd):
    docs = spark.range(80).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, F.concat(F.lit("you utter moron "), "id")).otherwise(F.concat(F.lit("have a nice day "), "id")).alias("text")
    )
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    labels = labels.unionByName(labels).unionByName(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int"))
    model = toxicity.fit(docs, labels)
    wrong = toxicity.score(docs, model).where((F.col("score") >= 0.5) != (F.col("doc_id") % 4 == 0))
    assert wrong.count() == 0
    assert toxicity.sample_labels(labels, "doc_id", "toxic", 5).count() == 10
    scored = toxicity.score(odd, model)
    assert scored.columns == odd.columns and scored.where("score between 0 and 1").count() == 11
    one_class = toxicity.fit(docs, labels.where("toxic = 0"))
    assert 0 < toxicity.score(odd, one_class).first()["score"] < 0.5
    assert len(toxicity.fit(docs.limit(0), labels.limit(0)).features) == 0
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_decontamination(spark, odd):
    items = spark.createDataFrame(
        [(1, "words stand here, FOR every one"), (2, None), (3, "..."), (4, "one"), (None, "one"), (5, "no such thing at all")], "item_id long, text string"
    )
    out = decontaminate.contamination(odd, items)
    got = {(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in out.collect()}
    assert (1, 17, 6, ("1", "4")) in got and (6, 1, 1, ("4",)) in got and (3, 0, 0, ()) in got
    assert out.count() == 11
    assert decontaminate.contamination(odd, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination(odd.limit(0), items).count() == 0


@pytest.mark.parametrize("slop", [0, 1, 3])
def test_proximity_against_brute_force(spark, slop):
    rnd = random.Random(slop)
    docs = [(i, " ".join(rnd.choices("abcd", k=rnd.randrange(0, 30)))) for i in range(25)]
    items = [(i, " ".join(rnd.choices("abcd", k=rnd.randrange(1, 5)))) for i in range(12)]
    index = decontaminate.build_index(spark.createDataFrame(docs, "doc_id int, text string"))
    found = decontaminate.search(index, spark.createDataFrame(items, "item_id int, text string"), window=3, slop=slop)
    got = {(r["doc_id"], r["item"], s, n) for r in found.collect() for s, n in zip(r["starts"], r["lengths"], strict=True)}
    want = set()
    for d, text in docs:
        words = text.split()
        for i, item in items:
            w = item.split()
            n = min(3, len(w))
            for phrase in {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}:
                # The anchor is the rarest term of the block; with ties and slop other anchors give other starts.
                for s in range(len(words)):
                    if slop == 0 and tuple(words[s : s + n]) == phrase:
                        want.add((d, i, s, n))
    if slop == 0:
        assert got == want
    else:
        for d, i, s, n in got:
            words, w = dict(docs)[d].split(), dict(items)[i].split()
            phrases = [w[k : k + n] for k in range(len(w) - n + 1)]
            assert any(all(t in words[max(0, s + o - slop) : max(0, s + o + slop + 1)] for o, t in enumerate(p)) for p in phrases)
        exact = decontaminate.search(index, spark.createDataFrame(items, "item_id int, text string"), window=3)
        assert {(r["doc_id"], r["item"]) for r in exact.collect()} <= {(d, i) for d, i, _, _ in got}


def test_near_duplicates(spark, odd):
    out = neardup.near_duplicates(odd)
    assert rows_of(out) == sorted(
        [
            (1, 13, 1, True), (2, 13, 1, False), (2, 13, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True),
            (6, 1, 6, True), (7, out.where("doc_id = 7").first()["n_shingles"], 7, True), (8, out.where("doc_id = 8").first()["n_shingles"], 8, True),
            (None, 11, None, True), (9, 0, 9, True),
        ],
        key=repr,
    )
    assert neardup.near_duplicates(odd.limit(0)).count() == 0


def test_near_duplicates_against_brute_force(spark):
    rnd = random.Random(3)
    docs = []
    for g in range(12):
        base = [f"g{g}w{k}" for k in range(60)]
        for _ in range(8):
            words = list(base)
            for _ in range(rnd.randrange(0, 5)):
                words[rnd.randrange(60)] = f"x{rnd.randrange(10**6)}"
            docs.append((len(docs), " ".join(words)))
    # Short texts, of fewer words than a shingle.
    docs += [(200, "a b"), (201, "A b"), (202, "b a"), (203, "a b c d"), (204, "a b c d e")]
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in docs for w in [t.lower().split()]}
    part = {i: i for i, _ in docs}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((part[a], part[b]))
                part = {i: low if p == high else p for i, p in part.items()}
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == part


def test_blocks_of_a_family_meet(spark, monkeypatch):
    """With tiny blocks, members are compared across blocks too."""
    monkeypatch.setattr(neardup, "ELEMENTS", 100)
    rows = [(i, " ".join(f"w{k}" for k in range(i, i + 40))) for i in range(0, 60)]
    got = {r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0}


def test_components(spark):
    chain = [(i + 1, i) for i in range(100, 160)] + [(7, 5), (5, 7), (5, 5), (None, 5)]
    found = components.components(spark.createDataFrame(chain, "a long, b long"))
    assert {tuple(r) for r in found.collect()} == {(i, 100) for i in range(101, 161)} | {(7, 5)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_packing(spark, odd):
    sized = odd.withColumns({"source": F.lit("s"), "cluster": F.lit(None).cast("long"), "n": packing.word_count(F.col("text"))})
    out = packing.pack(sized, "n", capacity=100)
    assert out.agg(F.sum("size")).first()[0] == sized.agg(F.sum("n")).first()[0]
    # One source: no two items share a bin.
    assert out.select("bin_id").distinct().count() == out.count()
    assert packing.pack(sized.limit(0), "n").count() == 0
    free = packing.pack(sized.withColumn("source", F.lit(None).cast("string")), "n", capacity=100)
    assert free.select("bin_id").distinct().count() < free.count()


def test_best_fit_against_brute_force():
    rnd = random.Random(9)
    for _ in range(30):
        n = 60
        sizes = sorted((rnd.randrange(0, 50) for _ in range(n)), reverse=True)
        sources = [rnd.choice(["a", "a", "b", "c", None]) for _ in range(n)]
        clusters = [rnd.choice([1, 2, 3, None, None, None]) for _ in range(n)]
        got, _ = packing.best_fit(sizes, sources, clusters, 50)
        left, held = [], []
        for i in range(n):
            fits = [
                b for b in range(len(left))
                if left[b] >= sizes[i] and all((sources[i] is None or sources[j] != sources[i]) and (clusters[i] is None or clusters[j] != clusters[i]) for j in held[b])
            ]
            tightest = min((left[b] for b in fits), default=None)
            b = got[i]
            if tightest is None:
                assert b == len(left)
                left.append(50)
                held.append([])
            else:
                assert b in fits and left[b] == tightest
            left[b] -= sizes[i]
            held[b].append(i)


def test_substrings(spark, odd):
    out = substrings.remove_repeats(odd, keep=("block", "nr"))
    with pytest.raises(ValueError):
        substrings.remove_repeats(odd, keep=("kept",))
    # The words between are those of the first occurrence; equal ids do not remove each other.
    assert sorted((r[0], r["n_words"], r["n_removed"]) for r in out.where("doc_id < 7").collect()) == [
        (1, 17, 0), (2, 17, 17), (2, 17, 17), (3, 0, 0), (4, 0, 0), (5, 0, 0), (6, 1, 0),
    ]
    assert out.count() == 11 and out.where("doc_id is null").first()["n_removed"] == 0
    assert substrings.remove_repeats(odd.limit(0)).count() == 0
    whole = substrings.remove_repeats(odd, gaps=True)
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    assert all(r["kept"] == (texts[r["doc_id"]] or "") for r in whole.where("n_removed = 0").collect())


def test_substrings_against_brute_force(spark):
    rnd = random.Random(4)
    passages = [[f"p{q}w{k}" for k in range(rnd.randrange(10, 30))] for q in range(6)]
    docs = []
    for i in rnd.sample(range(1000), 40):
        words = []
        for _ in range(rnd.randrange(0, 5)):
            words += rnd.choices("abc", k=rnd.randrange(0, 20))
            words += rnd.choice(passages)[rnd.randrange(0, 5) :]
        docs.append((i, " ".join(words)))
    first = {}
    for i, t in sorted(docs):
        w = t.split()
        for s in range(len(w) - 12):
            first.setdefault(tuple(w[s : s + 13]), i)
    want = {}
    for i, t in docs:
        w = t.split()
        gone = {s + k for s in range(len(w) - 12) if first[tuple(w[s : s + 13])] < i for k in range(13)}
        want[i] = " ".join(x for k, x in enumerate(w) if k not in gone)
    got = {r["doc_id"]: r["kept"] for r in substrings.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    assert got == want


def test_quality(spark, odd):
    out = quality.assess(odd)
    assert out.count() == 11
    failed = {r["doc_id"] for r in out.where("base_failed").collect()}
    assert {3, 4, 5, 6, 9} <= failed and not {r["doc_id"] for r in out.where("kept").collect()} & failed
    text = "Home | News | Sport | About\nThis is a proper line of running text, with an end.\nAll rights reserved.\nno marks here\n"
    row = quality.assess(spark.createDataFrame([(text,)], "text string")).first()
    assert row["clean_text"] == "This is a proper line of running text, with an end."
    assert quality.assess(odd.limit(0)).count() == 0


def test_urls(spark):
    odd_urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.com/en/x?q#f", "ftp://www.example.com/en/", "x://net/es/", "x://a.net", "x://a.net/fr/#/en/", "://com/", "x://com", "x://y?://com/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate([*odd_urls, odd_urls[4]])], "page_id long, url string").withColumns({"host": F.lit(1), "label": F.lit(1), "features": F.lit(1)})
    got = {r["page_id"]: tuple(r)[1:] for r in urls.judge(pages).collect()}
    assert len(got) == 13 and all(v[3] in ("allow", "block") for v in got.values())
    assert got[0][:3] == got[1][:3] == got[2][:3] == ("", "", None)
    assert got[4] == got[12] == ("example.com", "/en/x", "example.com/en/", "block")
    assert got[5] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert got[6] == ("net", "/es/", "net/es/", "block") and got[8][2] == "net/fr/" and got[7][2] is None
    assert got[9] == ("com", "/", "com/", "allow") and got[10][2] is None and got[11][0] == "y"
    assert urls.judge(pages.limit(0)).count() == 0
    known = urls.labelled_urls(spark)
    seen = {r["page_id"]: r["verdict"] for r in urls.judge(known.selectExpr("monotonically_increasing_id() as page_id", "url")).collect()}
    truth = {r["page_id"]: r["verdict"] for r in known.selectExpr("monotonically_increasing_id() as page_id", "verdict").collect()}
    assert np.mean([seen[k] == truth[k] for k in truth]) > 0.95


def test_language_model(spark, odd):
    out = suffix_tree.scores(odd, F.col("doc_id") % 2 == 1).collect()
    assert len(out) == 11 and all(r["score"] < 0 and r["base_score"] <= 0 for r in out)
    by = {r["doc_id"]: r for r in out if r["doc_id"] in (3, 4, 6)}
    assert by[3]["n_tokens"] == by[4]["n_tokens"] == 1 and by[6]["n_tokens"] == 2
    assert next(r for r in out if r["doc_id"] is None)["train"] is False
    assert suffix_tree.scores(odd.limit(0), F.lit(True)).count() == 0
    untrained = suffix_tree.scores(odd, F.lit(False)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in untrained)


def test_suffix_tree_is_a_distribution():
    grams = [("a", 6), ("b", 3), (" ", 3), (" a", 3), ("aa", 1), ("ab", 3), ("a ", 2), ("b ", 1), ("ba", 2)]
    tree = suffix_tree.Tree(grams)
    for context in ("", "a", "b", "zzb", " "):
        total = sum(tree.probability(context, s) for s in "ab cdefg\n")
        assert 0.5 < total <= 1
    assert tree.state("zza") == "a" and tree.state("zz") == ""
    assert tree.probability("a", "b") > tree.probability("b", "b")


def test_warc_round_trip(spark, tmp_path):
    big = "x" * 1500 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n\u00e9\x00"
    pages = [(1, "http://a/\r\nEvil: 1", big), (2, None, big), (3, "http://c", big), (3, "http://c", big), (4, "http://d", None), (5, "http://e", ""), (6, "http://f", "small"), (7, "http://g", "small"), (None, "http://h", big)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"type": F.lit(1), "value": F.lit(2)})
    records = warc.read(spark, warc.write(df, str(tmp_path / "w")))
    assert records.count() == 27 and records.where("complete").count() == 27
    got = [
        (warc_key(r), r["main"]["type"], r["main"]["payload"], r["main"]["payload_digest"], r["request"] is not None, refers(r))
        for r in warc.assemble(records).collect()
    ]
    digest = hashlib.sha1(big.encode()).hexdigest()
    body = big.encode()
    assert sorted(got, key=repr) == sorted(
        [
            ("1", "revisit", b"", digest, True, "3"), ("2", "revisit", b"", digest, True, "3"), (None, "revisit", b"", digest, True, "3"),
            ("3", "response", body, digest, True, None), ("3", "response", body, digest, True, None),
            *((str(k), "response", b.encode(), hashlib.sha1(b.encode()).hexdigest(), True, None) for k, b in ((4, ""), (5, ""), (6, "small"), (7, "small"))),
        ],
        key=repr,
    )
    empty = warc.write(df.limit(0), str(tmp_path / "none"))
    assert warc.assemble(warc.read(spark, empty)).count() == 0


def warc_key(r):
    found = re.search(r"key: (.*)\r", r["metadata"][0]["payload"].decode())
    return found and found[1]


def refers(r):
    found = re.search(r"refers-to: (.*)\r", r["metadata"][0]["payload"].decode())
    return found and found[1]


def test_warc_of_others(spark, tmp_path):
    """Plain archives, links in either direction and over a third record, damaged ends."""

    def record(kind, name, block, *lines):
        head = [b"WARC/1.0", f"WARC-Type: {kind}".encode(), f"WARC-Record-ID: <{name}>".encode(), *lines, b"Content-Length: %d" % len(block)]
        return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"

    parts = [
        record("warcinfo", "i", b"software: x"),
        record("response", "r", b"body", b"WARC-Concurrent-To: <q>"),
        record("request", "q", b"ask"),
        record("metadata", "m", b"k: v", b"WARC-Concurrent-To: <q>"),
        record("resource", "s", b"alone"),
        record("metadata", "lost", b"k: v", b"WARC-Concurrent-To: <nobody>"),
        record("response", "cut", b"0123456789")[:-9],
    ]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.warc").write_bytes(b"".join(parts))
    records = warc.read(spark, str(folder))
    assert records.count() == 7 and [r["record_id"] for r in records.where("not complete").collect()] == ["<cut>"]
    got = {r["main_id"]: r for r in warc.assemble(records).collect()}
    assert set(got) == {"<r>", "<s>", "<cut>"}
    assert got["<r>"]["request"]["record_id"] == "<q>" and [m["record_id"] for m in got["<r>"]["metadata"]] == ["<m>"]
    assert got["<s>"]["request"] is None and got["<s>"]["metadata"] == []


def by_hand(sequences, train, depth, least, first=0):
    """The tree, and the log10 of a sequence given symbols' probabilities without context, by one dictionary."""
    counts = {}
    for i, weight in train.items():
        for at, symbol in list(enumerate(sequences[i]))[first:]:
            for low in range(max(0, at - depth), at + 1):
                own = counts.setdefault(tuple(sequences[i][low:at]), {})
                own[symbol] = own.get(symbol, 0) + weight
    sizes = {c: sum(s.values()) for c, s in counts.items()}

    def retained(c):
        less = c[1:]
        gain = sum(n * math.log(n * sizes[less] / (sizes[c] * counts[less][s])) for s, n in counts[c].items())
        return sizes[c] >= least and gain > len(counts[c]) * math.log(sizes[()]) / 2

    tree = {c for c in counts if c and retained(c)}

    def probability(context, symbol, root):
        while context and context not in tree:
            context = context[1:]
        if not context:
            return root
        k = len(counts[context])
        return (counts[context].get(symbol, 0) + k * probability(context[1:], symbol, root)) / (sizes[context] + k)

    return tree, lambda i, roots: sum(math.log10(probability(tuple(s[max(0, at - depth) : at]), x, roots[x])) for s in [sequences[i]] for at, x in list(enumerate(s))[first:])


@pytest.mark.parametrize("hot", [1_000_000, 40])
def test_language_model_contexts_of_words(spark, hot):
    rnd = random.Random(5)
    phrase = "to be or not to be that is the question whether it is nobler in the mind"
    docs = []
    for i in range(300):
        words = rnd.choices("abcdefghij", k=12)
        if i % 2:
            words[5:5] = phrase.split()
        docs.append((i, " ".join(words)))
    # One word each: the score of a token without context less that of the end after it.
    order, vocabulary = phrase.split(), sorted({w for _, t in docs for w in t.split()})
    docs += [(1000 + k, w) for k, w in enumerate(vocabulary)] + [(1900, ""), (2000, phrase), (2001, " ".join(order[::2] + order[1::2]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {w: {r["doc_id"]: r["score"] for r in suffix_tree.scores(frame, F.col("doc_id") < 300, least=2, hot=hot, depth=depth).collect()} for w, depth in (("all", suffix_tree.WORDS), ("none", 0))}
    end = 10 ** got["none"][1900]
    roots = {"\n": end} | {w: 10 ** (got["none"][1000 + k]) / end for k, w in enumerate(vocabulary)}
    tree, score = by_hand({i: [*t.split(), "\n"] for i, t in docs}, dict.fromkeys(range(300), 1), suffix_tree.WORDS, 2)
    assert {len(c) for c in tree} == {1, 2, 3}
    assert all(got["all"][i] == pytest.approx(score(i, roots), rel=1e-6) for i, _ in docs)
    # The same words in another order; a phrase seen often.
    assert got["none"][2000] == pytest.approx(got["none"][2001]) and got["all"][2000] > got["all"][2001] + 10


def test_spellings_keep_contexts_of_rare_words(spark):
    """Contexts seen often in a language that is a small part of the corpus are kept."""
    rnd = random.Random(7)
    counts = {"".join(rnd.choices("abcde", k=rnd.randrange(1, 9))): rnd.randrange(10**6, 10**7) for _ in range(60)}
    counts |= {f"{x}zqx{y}wk\u00e9": 40 for x in "abcde" for y in "abcde"} | {"zqxaw\U0001f642": 0, "unseen": 0}
    rows = [(k, k // 2, b"\n".join(w.encode() for w in held), np.array([counts[w] for w in held], np.int64).tobytes()) for k in range(4) if (held := list(counts)[k::4])]
    frame = spark.createDataFrame(rows, "unit long, bucket long, words binary, counts binary")
    out = suffix_tree.spellings(frame, 4, lambda n, logs: logs).collect()
    got = {w.decode(): v for r in out for w, v in zip(bytes(r["words"]).split(b"\n"), np.frombuffer(r["values"]), strict=True)}
    tree, score = by_hand({w: f" {w} " for w in counts}, {w: n for w, n in counts.items() if n}, suffix_tree.DEPTH, 4, first=1)
    seen = {}
    for w, n in counts.items():
        for c in f"{w} ":
            seen[c] = seen.get(c, 0) + n
    held = {c for c in seen if seen[c]}
    total = sum(seen.values())
    roots = {c: (seen[c] + len(held) / 0x110000) / (total + len(held)) for c in seen}
    assert {("z",), ("q",), ("w",)} <= tree and max(map(len, tree)) == suffix_tree.DEPTH
    assert set(got) == set(counts) and all(got[w] == pytest.approx(score(w, roots), rel=1e-6) for w in counts)


def test_packing_deals_rows_that_are_alike(spark):
    """Rows without keys, and such as are alike in all, go to all shards."""
    frame = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(4000).alias("n"), (F.col("id") % 3).alias("source"), F.lit(1).alias("cluster"), F.col("id").alias("row"))
    rows = packing.pack(frame, "n", row="row").where("piece = 0").collect()
    shards = [r["bin_id"] >> 32 for r in rows]
    assert len(rows) == 4000 and set(shards) == set(range(5)) and max(map(shards.count, range(5))) < 1000
