"""Row samples: Bernoulli (default) or keyed, approximate size or exact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill import scratch
from gristmill.functions import key_rank, quoted
from gristmill.functions.hashing import RANK_BITS

SEED = 42
RANK, TIE, LAST = "_rank", "_tie", "_last"


def fraction(df: DataFrame, share: float, seed: int = SEED) -> DataFrame:
    """Bernoulli sample without replacement. Repeats only for the same partitioning."""
    return df.sample(withReplacement=False, fraction=share, seed=seed)


def keyed(
    df: DataFrame, key: str | Sequence[str], threshold: int, modulus: int = 1 << RANK_BITS
) -> DataFrame:
    """Rows whose key rank modulo ``modulus`` is below ``threshold``.

    A row-local filter: no shuffle, and the same rows under any partitioning. Rows
    with equal keys are taken or left together.
    """
    return df.where(key_rank(key) % F.lit(modulus) < F.lit(threshold))


def to_target(
    df: DataFrame,
    target: int,
    seed: int = SEED,
    cap: bool = False,
    key: str | Sequence[str] | None = None,
    total: int | None = None,
) -> DataFrame:
    """Sample about ``target`` rows, or at most ``target`` with ``cap=True``.

    The share is ``min(1, target / max(1, total))``; pass ``total`` when it is already
    known to save the count. With ``cap`` a table that fits is returned unchanged;
    a larger one is sampled and then cut to ``target`` rows. With a ``key`` the choice
    depends on the key values alone, and ``cap`` gives exactly ``target`` rows.
    """
    if total is None:
        total = df.count()
    share = min(1.0, target / max(1, total))
    if cap and total <= target:
        return df
    if key is not None:
        if cap:
            # Rows of an equal key are told apart by all their columns.
            low = F.lit((1 << RANK_BITS) - 1)
            row = row_hash(df)
            halves = {TIE: F.shiftrightunsigned(row, RANK_BITS), LAST: row.bitwiseAND(low)}
            ranked = df.withColumns({RANK: key_rank(key), **halves})
            return lowest_ranks(ranked, [RANK, TIE, LAST], target).drop(RANK, TIE, LAST)
        return keyed(df, key, round(share * (1 << RANK_BITS)))
    drawn = fraction(df, share, seed)
    if not cap:
        return drawn
    # The draw is about `target` rows; it is written once, because the cut below
    # takes several jobs and all of them have to see the same draw.
    rank = lambda s: (F.rand(s) * float(1 << RANK_BITS)).cast("bigint")
    drawn = scratch.materialize(drawn.withColumns({RANK: rank(seed), TIE: rank(seed + 1)}), "draw")
    return lowest_ranks(drawn, [RANK, TIE], target).drop(RANK, TIE)


def row_hash(df: DataFrame):
    """A 64-bit hash of all columns; maps, which have no hash, go by their sorted entries as text."""
    parts = []
    for f in df.schema.fields:
        col = F.col(quoted(f.name))
        parts.append(F.to_json(F.struct(col)) if "map<" in f.dataType.simpleString() else col)
    return F.xxhash64(*parts)


def lowest_ranks(df: DataFrame, ranks: Sequence[str], n: int) -> DataFrame:
    """Exactly the ``n`` first rows by 32-bit ranks (all rows when there are fewer).

    Neither a sort nor a global limit: two histograms of at most 65,536 counts locate
    the rank of the n-th row, lower ranks pass a plain filter, and only rows that share
    this one rank are searched by the next, in the same way. Rows equal in all ranks are
    equal rows but for a hash collision, so any of them do.
    """
    rank, *rest = ranks
    half = RANK_BITS // 2
    coarse = F.shiftright(F.col(rank), half)
    fine = F.col(rank).bitwiseAND(F.lit((1 << half) - 1))

    cut = _bucket_of(df, coarse, n)
    if cut is None:
        return df
    high, left, _ = cut
    low, left, ties = _bucket_of(df.where(coarse == F.lit(high)), fine, left)
    border = (high << half) + low
    if left == ties:
        return df.where(F.col(rank) <= F.lit(border))
    below = df.where(F.col(rank) < F.lit(border))
    at = df.where(F.col(rank) == F.lit(border))
    taken = lowest_ranks(at, rest, left) if rest else at.limit(left)
    return below.unionAll(taken)


def _bucket_of(df: DataFrame, bucket, n: int) -> tuple[int, int, int] | None:
    """The bucket of the n-th row, how many of its rows are among the first n, its size."""
    counts = df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    # The window sees one row per bucket, at most 65,536.
    upto = counts.select("b", "n", F.sum("n").over(Window.orderBy("b")).alias("upto"))
    hit = upto.where(F.col("upto") >= F.lit(n)).orderBy("b").first()
    return None if hit is None else (hit["b"], n - (hit["upto"] - hit["n"]), hit["n"])
