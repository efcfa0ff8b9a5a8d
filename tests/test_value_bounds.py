"""Packed values whose bounds settle which centre is the nearest."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill import scratch
from gristmill.operators import lloyd

ROWS = 64 * lloyd.BLOCK_ROWS


def brute(at, centers, ends):
    """``n, cost, sq`` and sums by centre, row by row."""
    x, w = at[:-1], at[-1]
    out = np.zeros((len(at) + 2, len(centers)))
    for low, high in zip(ends, ends[1:], strict=False):
        far = ((x - centers[low:high, :, None]) ** 2).sum(axis=1)
        own = far.argmin(axis=0)
        for row, told in zip(out, [w, far.min(axis=0) * w, (x**2).sum(axis=0) * w, *(x * w)], strict=True):
            row[low:high] += np.bincount(own, told, high - low)
    return out


def table(kind, n=ROWS):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3, n)) if kind == "spread" else rng.integers(0, 4, (3, n)).astype(float)
    return np.concatenate([x, rng.integers(0, 3, (1, n))])


def test_few_distances_are_taken(monkeypatch):
    """Most centres are out of reach of most values: far fewer distances than rows times centres."""
    monkeypatch.setattr(lloyd, "RUN", 1024)
    at = lloyd._gathered(table("spread", 16 * ROWS))
    centers, ends = np.random.default_rng(2).normal(size=(26, 3)), [0, 3, 7, 15, 26]
    taken, nearest_of = [], lloyd._nearest_of
    monkeypatch.setattr(lloyd, "_nearest_of", lambda part, near: taken.append(near.shape[0] * near.shape[1] * lloyd.BLOCK_ROWS) or nearest_of(part, near))
    got = np.zeros((6, 26))
    lloyd._added(lloyd._packed(at), 3, centers, ends, got)
    assert 0 < sum(taken) < 0.25 * at.shape[1] * len(centers)
    assert np.array_equal(got[0], brute(at, centers, ends)[0])


@pytest.mark.parametrize("kind", ["spread", "grid"])
@pytest.mark.parametrize("shift", [0.0, 1e6])
def test_sums_are_those_of_all_rows(kind, shift):
    """Also with rows that are as far from one centre as from another, copies, and far from the origin."""
    at = lloyd._gathered(table(kind))
    at[:-1] += shift
    centers = np.array([(1, 1, 1), (2, 2, 2), (1, 1, 1), (0, 3, 0), (3, 0, 3), (1, 2, 1), (9, 9, 9)], float) + shift
    got = np.zeros((6, 7))
    farthest = lloyd._added(lloyd._packed(at), 3, centers, [0, 2, 7], got)
    want = brute(at, centers, [0, 2, 7])
    assert np.array_equal(got[0], want[0])
    assert got == pytest.approx(want, rel=1e-9)
    assert farthest * (1 + 1e-9) >= ((at[:-1] - centers[:2, :, None]) ** 2).sum(axis=1).min(axis=0).max()


def test_packing_keeps_every_row_and_puts_neighbours_together(spark):
    rows = spark.range(0, 50_000, 1, 2).select(F.rand(1).alias("x"), F.rand(2).alias("y"), (F.col("id") % 3 + 1).alias("n"))
    rows = scratch.materialize(rows, "bounds-rows")
    held = lloyd.blocks(rows, ["x", "y"], "n").collect()
    told = np.array([np.frombuffer(r[lloyd.TOLD]) for r in held])
    sums = rows.agg(F.sum("n"), F.sum(F.col("x") * F.col("n")), F.sum(F.col("y") * F.col("n"))).first()
    assert told[:, [0, 3, 4]].sum(axis=0) == pytest.approx(list(sums), rel=1e-12)
    assert np.median(told[:, 7:] - told[:, 5:7]) < 0.15


def test_silhouettes_of_packed_rows_are_those_of_plain_ones(spark):
    rows = spark.range(0, 6000, 1, 2).select(*[F.round(F.randn(i) * 2, 1).alias(c) for i, c in enumerate("xyz")])
    rows = scratch.materialize(rows, "bounds-scores")
    rng = np.random.default_rng(4)
    sets = {k: [tuple(c) for c in rng.normal(size=(k, 3))] for k in (2, 5, 9)}
    sets[4] = [(0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (1e5, 1e5, 1e5), (-1.0, 2.0, 0.0)]
    packed = scratch.materialize(lloyd.blocks(rows, list("xyz")), "bounds-packed")
    assert lloyd.silhouettes(packed, list("xyz"), sets) == pytest.approx(lloyd.silhouettes(rows, list("xyz"), sets), abs=1e-12)
