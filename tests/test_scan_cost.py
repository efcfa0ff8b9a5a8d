"""What a scan of k-means sends to the Python workers."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gristmill import scratch
from gristmill.operators import lloyd


@pytest.fixture(scope="module")
def points(spark):
    rows = spark.range(4000).select(F.col("id"), F.rand(3).alias("x"), F.rand(4).alias("y"))
    return scratch.materialize(rows, "scan-cost")


@pytest.mark.parametrize("key", [[], ["id"]])
def test_only_rows_that_may_be_drawn_reach_the_worker(points, key, monkeypatch):
    sent, drawn = [], lloyd._drawn
    monkeypatch.setattr(lloyd, "_drawn", lambda ranked, *a: sent.append(ranked.count()) or drawn(ranked, *a))
    found = lloyd.seeds(points, ["x", "y"], [3, 5], key)
    assert sent and max(sent) < 400
    # All rows sent give the same starts.
    monkeypatch.setattr(lloyd, "_drawn", drawn)
    total = lloyd._total
    monkeypatch.setattr(lloyd, "_total", lambda *a, **named: (total(*a, **named)[0], float("inf")))
    assert lloyd.seeds(points, ["x", "y"], [3, 5], key) == found


def test_packed_scans_use_small_batches_and_put_the_setting_back(points, monkeypatch):
    spark = points.sparkSession
    before, seen = spark.conf.get(lloyd.BATCH), []
    packed = scratch.materialize(lloyd.blocks(points, ["x", "y"]), "scan-blocks")
    setting = scratch.setting
    monkeypatch.setattr(scratch, "setting", lambda s, name, value: seen.append((name, value)) or setting(s, name, value))
    lloyd.iterate(packed, ["x", "y"], {2: [(0.0, 0.0), (1.0, 1.0)]}, max_iter=1)
    assert (lloyd.BATCH, str(lloyd.BATCH_BLOCKS)) in seen
    assert spark.conf.get(lloyd.BATCH) == before


def test_sliced_values_are_unpacked():
    at = np.arange(3 * 4 * lloyd.BLOCK_ROWS, dtype=float).reshape(3, -1)
    values = lloyd._packed(at).column(0)
    assert np.array_equal(lloyd._unpacked(values, 3), at)
    assert np.array_equal(lloyd._unpacked(values.slice(1, 2), 3), at[:, lloyd.BLOCK_ROWS : 3 * lloyd.BLOCK_ROWS])
    assert lloyd._unpacked(pa.array([], pa.binary()), 3).shape == (3, 0)


@pytest.mark.parametrize("k", [3, 300])
def test_ties_go_to_the_first_centre(k):
    far = np.random.default_rng(5).integers(0, 4, (k, 1000)).astype(float)
    least, own = lloyd._nearest(far)
    assert np.array_equal(own, far.argmin(axis=0)) and np.array_equal(least, far.min(axis=0))
