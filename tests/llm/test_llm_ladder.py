import numpy as np
import pytest

from gristmill.llm.ladder import grouped, ordered


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
@pytest.mark.parametrize("kind", ["spread", "ties", "shared high bits"])
def test_keys_are_ordered_stably(n, kind):
    rnd = np.random.default_rng(3)
    keys = rnd.integers(0, 1 << 63, n, np.uint64)
    if kind == "ties":
        keys = keys[rnd.integers(0, max(1, n // 3), n)]
    if kind == "shared high bits":
        keys = (keys >> np.uint64(53) << np.uint64(40)) | rnd.integers(0, 1 << 10, n, np.uint64)
    assert (ordered(keys) == np.argsort(keys, kind="stable")).all()
    first, number = grouped(keys)
    distinct, inverse = np.unique(keys, return_inverse=True)
    assert (keys[first] == distinct).all() and (number == inverse).all()
