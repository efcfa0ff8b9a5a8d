"""Periodic runs, hard negatives and near vectors against brute force, and their edge cases."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.llm import hard_negatives, near_vectors, queries, runs

# ---- periodic runs -----------------------------------------------------------------


def brute_runs(words, least=6, periods=4):
    found = {}
    for q in range(1, len(words) // periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, periods * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def collapsed(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        docs = []
        for _ in range(rng.randint(1, 4)):
            n, k = rng.randint(0, 40), rng.randint(1, 4)
            words = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.5:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(3, 10)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            docs.append(words)
        least, periods = rng.choice([(2, 2), (6, 3), (6, 4)])
        lens = np.array([len(d) for d in docs])
        flat = np.array([w for d in docs for w in d], np.int64)
        got = list(zip(*[x.tolist() for x in runs.find_runs(flat, lens, least, periods)], strict=True))
        first = np.concatenate([[0], np.cumsum(lens)]).tolist()
        assert got == [(s + first[i], n, q) for i, d in enumerate(docs) for s, n, q in brute_runs(d, least, periods)]


def test_run_rows_of_edge_cases(spark):
    long = "x " + "a b c " * 30_000 + "y"
    texts = [None, "", " \t ", "a a a a a", "a a a a a a", "a b " * 4, "a b " * 4, long, "é é é é é é z"]
    rows = [(None if i == 4 else i, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = sorted((tuple(r) for r in runs.periodic_runs(docs).collect()), key=lambda r: (r[0] is None, r[0]))
    want = []
    for key, text, _ in rows:
        words = (text or "").split()
        found = [(1, 90_000, 3)] if text == long else brute_runs(words)
        want.append((key, len(words), found, collapsed(words, found)))
    want.sort(key=lambda r: (r[0] is None, r[0]))
    assert [(k, n, [tuple(x) for x in found], text) for k, n, found, text in got] == want
    assert runs.periodic_runs(docs.where("false")).collect() == []
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, periods=1)


def test_periodic_runs_query_equals_brute_force(spark, data):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.op11_periodic_runs(spark, data).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words = (texts[r["doc_id"]] or "").replace("\v", " ").split()
        h = zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if len(words) > 3000:
            continue
        found = brute_runs(words)
        best = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None, None, None))
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(found), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(words, found).encode()).hexdigest()


# ---- hard negatives ----------------------------------------------------------------


def brute_negatives(rows, is_anchor):
    chosen = {}
    for key, label, v in rows:
        if key is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        if max(map(abs, v)) <= (2**53 / len(v)) ** 0.5:
            chosen[key] = min(chosen.get(key, (label, v)), (label, v))
    out = []
    for a, (label, v) in chosen.items():
        if not is_anchor(a):
            continue
        scored = [(sum(int(x) * int(y) for x, y in zip(v, w, strict=True)), b, m) for b, (m, w) in chosen.items() if b != a and len(w) == len(v)]
        for s, p in sorted((-s, b) for s, b, m in scored if m == label)[:5]:
            fits = sorted((-t, b) for t, b, m in scored if m != label and 80 * -s <= 100 * t <= 100 * -s)[:5]
            out += [(a, p, rank, b, -s, -t) for rank, (t, b) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("elements, leaf", [(1 << 20, 256), (240, 4), (18, 1)])
def test_hard_negatives_equal_brute_force(spark, elements, leaf):
    rng = np.random.default_rng(5)
    # Few different values, so that scores tie; one label holds a third; keys repeat.
    rows = [(i, int(rng.choice([0, 0, 1, 2, 3])), [float(x) for x in np.floor(rng.normal(size=6) * rng.choice([2, 6]) + rng.choice([0, 2]))]) for i in range(240)]
    same = rows[0][2]
    rows += [(700, None, same), (None, 1, same), (701, 1, None), (702, 1, []), (703, 1, [math.nan] * 6), (704, 1, [None] * 6), (705, 1, [1e300] * 6)]
    rows += [(706, 1, [3.0, 4.0]), (710, 2, [3.0, 5.0]), (720, 2, [3.0, 4.0]), (730, 2, [0.0] * 6), (1, 0, rows[1][2]), (10, 3, rows[10][2])]
    rows += [(740 + i, i, same) for i in range(4)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, label int, vector array<double>, rank int")
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, elements=elements, leaf=leaf)
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows, lambda a: a % 10 == 0)


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame([(0, 1, [1, 2])], "vec_id long, label int, vector array<int>")
    assert hard_negatives.hard_negatives(df.where("false"), F.lit(True)).collect() == []
    assert hard_negatives.hard_negatives(df, F.lit(True)).collect() == []


def test_boxes_bound_products_and_searches_drop_boxes():
    rng = np.random.default_rng(2)
    rows = np.floor(rng.normal(size=(4000, 3)) * 50)
    order = hard_negatives.str_order(rows, 16)
    assert sorted(order.tolist()) == list(range(4000))
    tree = hard_negatives.Tree(np.arange(4000), rows[order], 16, 8)
    anchors = np.floor(rng.normal(size=(20, 3)) * 50)
    scores = anchors @ tree.rows.T
    for size, (low, high) in zip((16, 128, 1024), tree.bounds(anchors), strict=False):
        for node in range(low.shape[1]):
            part = scores[:, node * size : (node + 1) * size]
            assert (low[:, node] <= part.min(axis=1)).all() and (part.max(axis=1) <= high[:, node]).all()

    class Counted(np.ndarray):
        seen = 0

        def __matmul__(self, other):
            Counted.seen += len(self)
            return np.asarray(self) @ other

    tree.rows = tree.rows.view(Counted)
    for a, bounds in enumerate(zip(*[[(x[i], y[i]) for i in range(20)] for x, y in tree.bounds(anchors)], strict=True)):
        (value, row), = tree.search(anchors[a], list(bounds), np.array([-math.inf]), np.array([math.inf]), 5, -1)
        want = sorted(zip((-scores[a]).tolist(), range(4000), strict=True))[:5]
        assert [(-v, r) for v, r in zip(value.tolist(), row.tolist(), strict=True)] == want
    assert Counted.seen < 20 * 4000 / 4


# ---- near vectors ------------------------------------------------------------------


def brute_near(rows, threshold):
    unit = []
    for key, label, v in rows:
        good = key is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        x = np.array(v, float) / max(map(abs, v)) if good else None
        unit.append(x / np.sqrt(x @ x) if good else None)
    links = [
        [j for j in range(len(rows)) if j != i and unit[i] is not None and unit[j] is not None and rows[i][1] == rows[j][1] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold]
        for i in range(len(rows))
    ]
    alike = {}
    for i, r in enumerate(rows):
        if unit[i] is not None:
            alike.setdefault(r[0], []).append(i)
    out = []
    for i, (key, _, _) in enumerate(rows):
        seen, left = {i}, [i] if unit[i] is not None else []
        while left:
            k = left.pop()
            new = {*links[k], *alike[rows[k][0]]} - seen
            seen |= new
            left += new
        least = None if key is None else min(rows[k][0] for k in seen)
        out.append((key, len(links[i]), least, key is None or key == least))
    return sorted(out, key=repr)


@pytest.mark.parametrize("elements", [1 << 18, 36, 1])
def test_near_vectors_equal_brute_force(spark, elements):
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(30):
        base = rng.normal(size=12)
        for _ in range(rng.integers(1, 9)):
            v = base + rng.normal(size=12) * rng.choice([0, 0.03, 0.08, 0.12, 0.2])
            # Labels differ in size; keys repeat.
            rows.append((int(rng.integers(0, 300)), int(rng.integers(0, 3)) if rng.random() < 0.5 else 0, [float(np.float32(x)) for x in v]))
    one = rows[0][2]
    rows += [(1000, None, one), (None, 0, one), (1001, 0, None), (1002, 0, []), (1003, 0, [0.0] * 12), (1004, 0, [math.nan] * 12)]
    rows += [(1005, 0, [math.inf, *one[1:]]), (1006, 0, [None, *one[1:]]), (1007, 0, [1.0, 2.0]), (1008, 0, [2.0, 4.0])]
    rows += [(5, 0, rows[3][2]), (5, 0, rows[9][2]), (1009, 0, [1e30] * 12), (1010, 0, [-0.0, *[1e-30] * 11]), (1011, 0, [0.0, *[1e-30] * 11])]
    df = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, label int, embedding array<float>, n_links int")
    got = near_vectors.near_vectors(df, elements=elements).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_near(rows, 0.98)


def test_near_vectors_of_nothing(spark):
    df = spark.createDataFrame([(3, 1, None), (4, 1, [1.5, 2.5])], "vec_id long, label int, embedding array<double>")
    assert near_vectors.near_vectors(df.where("false")).collect() == []
    assert sorted(tuple(r) for r in near_vectors.near_vectors(df).collect()) == [(3, 0, 3, True), (4, 0, 4, True)]
    with pytest.raises(ValueError):
        near_vectors.near_vectors(df, threshold=0.0)


def test_a_group_of_copies_links_as_a_whole(spark):
    """Near copies over several blocks: all are linked with each other, equal ones count each."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=16)
    rows = [(i, 0, (base + rng.normal(size=16) * 1e-3 * (i % 5 > 0)).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = near_vectors.near_vectors(df, elements=16 * 40).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(299, 0)}
    assert [r["vec_id"] for r in got if r["kept"]] == [0]
