"""K-means for several numbers of clusters at once: keyed seeding and joint iterations.

An iteration is one scan for all k together. The centres travel with the tasks, each task adds up
its rows by k and cluster and returns k x d numbers; no row is shuffled. The draws of the seeding
are ranks of a key (or of the coordinates), so the fit does not depend on how the rows are
partitioned, but for the rounding of sums.

Distances are taken by Arrow batches. As literals of generated code, the centres of eight k are a
method too long to be compiled: ten times slower, and compiled anew in every iteration.

Rows may carry a weight, the number of equal rows they stand for. Tables that are scanned often are
packed first (``blocks``): 64 rows that lie near each other are one value. Of a value most centres are
farther from all of its rows than another one, which its bounds tell, so distances are taken to the
few that are left; where one is left, the sums of the value are added as they are. No row is left out.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from gristmill import scratch
from gristmill.functions import key_rank, quoted
from gristmill.functions.hashing import RANK_BITS

# What runs in tasks travels with the job; executors need no copy of this module.
register_pickle_by_value(sys.modules[__name__])

SEED = 42
#: Distances that a task works on at a time: few enough for a core's cache.
DISTANCES = 1 << 16
#: The packed column, the rows in one value of it, and the values of an Arrow batch: 1.3 MB for four
#: coordinates, which stays in a core's cache on its way into the worker.
BLOCK = "_block"
#: Beside it, of each value: rows, cost about their mean, squared norm, sums and bounds of the coordinates.
TOLD = "_told"
PACKED = f"{BLOCK} binary, {TOLD} binary"
BLOCK_ROWS = 64
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_BLOCKS = 1000
#: Rows are sorted by a Z-order number of so many bits in all, of deviations up to so many standard ones; then runs
#: of so many values' rows are put to values, some runs at a time.
Z_BITS, Z_REACH = 32, 3.0
RUN, RUNS = 64, 16
#: Share of the squared numbers that rounding may cost a comparison of distances; far more than it does.
ROUNDING = 1e-12
#: Rounds of oversampling, and rows drawn in each for every cluster of the largest k.
ROUNDS = 2
OVERSAMPLE = 2

Centers = Sequence[Sequence[float]]


def _coordinates(
    points: DataFrame, cols: Sequence[str], key: Sequence[str] = (), weight: str | None = None
) -> tuple[DataFrame, list[str]]:
    """Complete rows as ``x0..`` and ``w``, and ``key0..`` where there is a key."""
    xs = [f"x{j}" for j in range(len(cols))]
    rows = points.select(
        *[F.col(quoted(c)).cast("double").alias(x) for c, x in zip(cols, xs, strict=True)],
        (F.lit(1.0) if weight is None else F.col(quoted(weight)).cast("double")).alias("w"),
        *[F.col(quoted(c)).alias(f"key{j}") for j, c in enumerate(key)],
    )
    return rows.where(reduce(and_, [F.col(x).isNotNull() & ~F.isnan(x) for x in xs])), xs


def blocks(points: DataFrame, cols: Sequence[str], weight: str | None = None) -> DataFrame:
    """The complete rows of ``points`` packed, for tables that are scanned often: store the result.

    A value holds the coordinates and weights of ``BLOCK_ROWS`` rows that are near each other among those
    of a task, for which each task sorts its rows; what a last one has too many weighs nothing. ``step``,
    ``iterate`` and ``silhouettes`` take it in place of the points. The moments of the points are read first.
    """
    rows, xs = _coordinates(points, cols, weight=weight)
    most = BLOCK_ROWS * RUN * RUNS
    near = _cell(rows, xs)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
            n += batch.num_rows
            if n >= most:
                yield from _sorted_values(held)
                held, n = [], 0
        if n:
            yield from _sorted_values(held)

    return rows.select(*xs, "w").sortWithinPartitions(near).mapInArrow(pack, PACKED)


def _cell(rows: DataFrame, xs: Sequence[str]) -> Column:
    """A Z-order number: the bits of the coordinates in turn, each cut to equal steps around its mean."""
    xs = xs[: Z_BITS - 1]
    told = rows.agg(*[f(x).alias(f"{n}{x}") for x in xs for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    bits = max(1, min(8, Z_BITS // len(xs)))
    spread = F.lit([sum((step >> bit & 1) << bit * len(xs) for bit in range(bits)) for step in range(1 << bits)]).cast("array<bigint>")
    number = F.lit(0).cast("bigint")
    for place, x in enumerate(xs):
        low, reach = (told[f"m{x}"] or 0.0), Z_REACH * (told[f"s{x}"] or 0.0) or 1.0
        step = (F.col(x) - F.lit(low - reach)) * F.lit((1 << bits) / (2 * reach))
        step = F.floor(F.greatest(F.least(step, F.lit(float((1 << bits) - 1))), F.lit(0.0))).cast("int")
        number = number + F.shiftleft(F.get(spread, step), place)
    return number


def _sorted_values(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    at = np.concatenate(held, axis=1)
    short = -at.shape[1] % BLOCK_ROWS
    at = np.pad(at, ((0, 0), (0, short)), "edge")
    at[-1, at.shape[1] - short :] = 0.0
    at = _gathered(at)
    for low in range(0, at.shape[1], rows := BATCH_BLOCKS * BLOCK_ROWS):
        yield _packed(at[:, low : low + rows])


def _gathered(at: np.ndarray) -> np.ndarray:
    """The rows, ``BLOCK_ROWS`` times any number, in an order where each ``BLOCK_ROWS`` are near each other.

    Runs of rows are halved by the widest of their coordinates until a value is left, all runs together.
    """
    width, whole = len(at), at.shape[1] - at.shape[1] % (BLOCK_ROWS * RUN)
    out, todo = [], [at[:, :whole].reshape(width, -1, BLOCK_ROWS * RUN), at[:, None, whole:]]
    while todo:
        runs = todo.pop()
        n, first = runs.shape[2], np.arange(runs.shape[1])
        if n <= BLOCK_ROWS or not runs.size:
            out.append(runs.reshape(width, -1))
            continue
        wide = np.ptp(runs[:-1], axis=2).argmax(axis=0)
        half = BLOCK_ROWS * (n // BLOCK_ROWS // 2)
        order = np.argpartition(runs[wide, first], half, axis=1) + first[:, None] * n
        runs = np.take(runs.reshape(width, -1), order.ravel(), axis=1).reshape(runs.shape)
        todo += [runs.reshape(width, -1, half)] if n == 2 * half else [runs[:, :, :half], runs[:, :, half:]]
    return np.concatenate(out, axis=1)


def thinned(packed: DataFrame, share: float, seed: int = SEED) -> DataFrame:
    """A Bernoulli sample of the packed rows: every weight becomes the number drawn of the rows it stands for.

    Repeats only for the same partitioning.
    """

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for batch in batches:
            values = batch.column(0)
            if len(values):
                at = _unpacked(values, len(batch.column(1)[0].as_py()) // 24)
                at[-1] = rng.binomial(at[-1].astype(np.int64), share)
                yield _packed(at)

    return packed.mapInArrow(draw, PACKED)


def _packed(at: np.ndarray) -> pa.RecordBatch:
    """Columns by rows, the weights last, as values of ``BLOCK_ROWS`` rows each."""
    held = np.ascontiguousarray(at.reshape(len(at), -1, BLOCK_ROWS).transpose(1, 0, 2))
    x, w = held[:, :-1], held[:, -1]
    low, high = held.min(axis=2, initial=np.inf), held.max(axis=2, initial=-np.inf)
    heavy = x * w[:, None]
    n, total = w.sum(axis=1, keepdims=True), heavy.sum(axis=2)
    # About its own mean the cost of a value is a sum of squares, whatever the centre it goes to.
    gap = x - (total / np.where(n > 0, n, 1.0))[:, :, None]
    cost, sq = np.einsum("vr,vjr,vjr->v", w, gap, gap), np.einsum("vjr,vjr->v", heavy, x)
    told = np.concatenate([n, cost[:, None], sq[:, None], total, low[:, :-1], high[:, :-1]], axis=1)
    # A column that is the same in all rows of a value, as weights mostly are, is one number.
    same = low == high
    size = len(at) + np.where(same, 1, BLOCK_ROWS).sum(axis=1)
    ends = np.concatenate([[0], np.cumsum(size)])
    starts = _starts(ends[:-1], same)
    flat = np.empty(ends[-1])
    np.put(flat, ends[:-1, None] + np.arange(len(at)), same)
    np.put(flat, starts[same], held[same][:, 0])
    np.put(flat, starts[~same][:, None] + np.arange(BLOCK_ROWS), held[~same])
    return pa.RecordBatch.from_arrays([_binary(flat, ends), _binary(told, np.arange(len(told) + 1) * told.shape[1])], names=[BLOCK, TOLD])


def _binary(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The numbers between each two of ``ends`` as a value."""
    offsets = np.ascontiguousarray(ends * flat.itemsize, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])


def _numbers(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all values, and where each value begins and the last one ends."""
    if not len(values):
        return np.empty(0), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_binary(values.type) else np.int32
    ends = np.frombuffer(values.buffers()[1], kind, len(values) + 1, values.offset * np.dtype(kind).itemsize).astype(np.int64)
    return np.frombuffer(values.buffers()[2], np.float64, (ends[-1] - ends[0]) // 8, ends[0]), (ends - ends[0]) // 8


def _starts(first: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Values by columns: where the numbers of each stand, after a mark for each column."""
    size = np.where(same, 1, BLOCK_ROWS)
    return first[:, None] + same.shape[1] + np.cumsum(size, axis=1) - size


def _unpacked(values: pa.Array, width: int) -> np.ndarray:
    """The columns by rows, a copy."""
    flat, ends = _numbers(values)
    same = flat[ends[:-1, None] + np.arange(width)] != 0
    starts, out = _starts(ends[:-1], same), np.empty((width, len(values), BLOCK_ROWS))
    for held, one, start in zip(out, same.T, starts.T, strict=True):
        held[one] = flat[start[one], None]
        if not one.all():
            held[~one] = np.lib.stride_tricks.sliding_window_view(flat, BLOCK_ROWS)[start[~one]]
    return out.reshape(width, -1)


def _scanned(points: DataFrame, cols: Sequence[str], weight: str | None) -> DataFrame:
    """What the tasks of a scan get: packed rows as they are, or the coordinates and weights."""
    if BLOCK in points.columns:
        return points
    rows, xs = _coordinates(points, cols, weight=weight)
    return rows.select(*xs, "w")


def _collected(scan: DataFrame, points: DataFrame) -> list[Row]:
    """The few rows of a scan of ``points``, with small batches if they are packed."""
    if BLOCK not in points.columns:
        return scan.collect()
    with scratch.setting(scan.sparkSession, BATCH, str(BATCH_BLOCKS)):
        return scan.collect()


def _distances(batch: pa.RecordBatch, d: int, centers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Some rows at a time: coordinates by rows, the weights, and squared distances, centres by rows."""
    if BLOCK in batch.schema.names:
        at = _unpacked(batch.column(0), d + 1)
    else:
        at = np.stack([batch.column(j).to_numpy(zero_copy_only=False) for j in range(d + 1)])
    rows = max(1, DISTANCES // max(1, len(centers)))
    for low in range(0, at.shape[1], rows):
        part, weight = at[:d, low : low + rows], at[d, low : low + rows]
        far, gap = np.zeros((len(centers), len(weight))), np.empty((len(centers), len(weight)))
        for j in range(d):
            np.subtract(part[j], centers[:, j, None], out=gap)
            np.multiply(gap, gap, out=gap)
            far += gap
        yield part, weight, far


def _nearest(far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the least distance and the first centre that has it."""
    kind = np.uint8 if len(far) <= 256 else np.int64
    least, own = far[0].copy(), np.zeros(far.shape[1], kind)
    for c in range(1, len(far)):
        # Numbers grow, so the last centre that was nearer has the largest one.
        np.maximum(own, (far[c] < least) * kind(c), out=own)
        np.minimum(least, far[c], out=least)
    return least, own.astype(np.int64)


def _near(low: np.ndarray, high: np.ndarray, centers: np.ndarray, offset: np.ndarray, ends: Sequence[int], places: int = 1) -> np.ndarray:
    """Centres by values: whether a centre may be among the ``places`` (1 or 2) nearest of its set for a row within the bounds.

    How far a row x is, is its squared norm and ``offset - 2 x.centre``; the squared distance with the squared norms
    of the centres. Bounds are coordinates by values, a set is what lies between two of ``ends``.

    The difference of two centres is linear in x, so its largest value is that in a corner.
    """
    mid, width, each = (low + high) / 2, high - low, np.arange(low.shape[1])
    far = offset[:, None] - 2 * (centers @ mid)
    slack = ROUNDING * ((np.maximum(np.abs(low), np.abs(high)) ** 2).sum(axis=0) + offset[:, None])
    beaten, held = np.ones(far.shape, bool), far
    for place in range(places):
        most, own = np.empty_like(far), np.empty(far.shape, np.int64)
        held = far.copy() if place == 0 else held
        for first, end in zip(ends, ends[1:], strict=False):
            best = held[first:end].argmin(axis=0) + first
            own[first:end], most[first:end] = best, far[best, each]
            held[best, each] = np.inf
        most -= far
        for j, wide in enumerate(width):
            turn = centers[own, j]
            turn -= centers[:, j, None]
            np.abs(turn, out=turn)
            turn *= wide
            most += turn
        beaten &= most < -slack
    return ~beaten


def _grouped(near: np.ndarray, ends: Sequence[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Numbers of values, for each the number of a set, and as many of its centres in their order.

    All that have one centre, all that have two, and so on, come together, cut to parts that a core's cache holds;
    a value comes once for each set.
    """
    sets = len(ends) - 1
    counts = np.add.reduceat(near, ends[:-1], axis=0, dtype=np.int64).T.ravel()
    starts, centre = np.cumsum(counts) - counts, np.nonzero(near.T)[1]
    for m in np.flatnonzero(np.bincount(counts)):
        same = np.flatnonzero(counts == m)
        for part in np.array_split(same, -(-len(same) * BLOCK_ROWS // DISTANCES) if m > 1 else 1):
            yield part // sets, part % sets, centre[starts[part][:, None] + np.arange(m)]


def _held(batch: pa.RecordBatch, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed rows as columns by values by rows, and what is told of the values, by values."""
    at = _unpacked(batch.column(0), d + 1).reshape(d + 1, -1, BLOCK_ROWS)
    return at, np.ascontiguousarray(_numbers(batch.column(1))[0].reshape(-1, 3 + 3 * d).T)


def _added(batch: pa.RecordBatch, d: int, centers: np.ndarray, ends: Sequence[int], sums: np.ndarray) -> float:
    """Add packed rows to ``n, cost, sq`` and the sums of coordinates by centre.

    Returns a number that no squared distance of a row to its centre exceeds.
    """
    at, told = _held(batch, d)
    (n, within, sq), total, low, high = told[:3], *np.split(told[3:], 3)
    mean, farthest = total / np.where(n > 0, n, 1.0), 0.0

    def add(centre: np.ndarray, each: Sequence[np.ndarray]) -> None:
        for row, part in zip(sums, each, strict=True):
            row += np.bincount(centre, part, len(centers))

    for values, _, near in _grouped(_near(low, high, centers, (centers**2).sum(axis=1), ends), ends):
        if near.shape[1] == 1:
            own = near[:, 0]
            to, m = centers[own].T, n[values]
            cost = within[values] + m * ((mean[:, values] - to) ** 2).sum(axis=0)
            add(own, [m, cost, sq[values], *total[:, values]])
            corner = np.maximum(np.abs(low[:, values] - to), np.abs(high[:, values] - to))
            farthest = max(farthest, float((corner**2).sum(axis=0).max(initial=0.0)))
            continue
        x, weight = at[:d, values], at[d, values]
        least, own = _nearest_of(x, centers[near])
        each = [np.ones_like(least), least, np.einsum("jvr,jvr->vr", x, x), *x]
        for i, centre in enumerate(near.T):
            heavy = weight * (own == i)
            add(centre, [np.einsum("vr,vr->v", heavy, e) for e in each])
        farthest = max(farthest, float(least.max(initial=0.0)))
    return farthest


def _scored(batch: pa.RecordBatch, d: int, centers: np.ndarray, ends: Sequence[int], size: np.ndarray, sq: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, float]:
    """The sums of the silhouettes of packed rows by set of centres, and the number of rows.

    ``size``, ``sq`` and ``mean`` tell of the rows of each centre.
    """
    at, told = _held(batch, d)
    low, high = np.split(told[3 + d :], 2)
    sums = np.zeros(len(ends) - 1)
    # Of the own centre and the nearest other one each may be the nearest in mean distance or the second.
    near = _near(low, high, centers, (centers**2).sum(axis=1), ends) | _near(low, high, mean, sq, ends, 2)
    for values, sets, chosen in _grouped(near, ends):
        x, weight = at[:d, values], at[d, values]
        own, norm = _nearest_of(x, centers[chosen])[1], np.einsum("jvr,jvr->vr", x, x)
        within, nearest, members = np.zeros(norm.shape), np.full(norm.shape, np.inf), np.zeros(norm.shape)
        for i, c in enumerate(chosen.T):
            to, mine = norm + sq[c, None], own == i
            for j, part in enumerate(x):
                to -= part * (2 * mean[c, j, None])
            np.copyto(within, to, where=mine)
            np.copyto(members, size[c, None], where=mine)
            np.minimum(nearest, to, out=nearest, where=~mine)
        within *= members / np.maximum(members - 1, 1)
        widest = np.maximum(within, nearest)
        counts = (members > 1) & (widest != 0) & (weight > 0)
        score = np.divide(nearest - within, widest, out=np.zeros(norm.shape), where=counts)
        sums += np.bincount(sets, np.einsum("vr,vr->v", score, weight), len(sums))
    return sums, float(told[0].sum())


def _nearest_of(part: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of values, each with centres of its own: the least distances, and which of the centres is the first that has it."""
    m = near.shape[1]
    least, own = np.full(part.shape[1:], np.inf), np.zeros(part.shape[1:], np.uint8 if m <= 256 else np.int64)
    far, gap = np.empty_like(least), np.empty_like(least)
    for i in range(m):
        far[:] = 0.0
        for j, held in enumerate(part):
            np.subtract(held, near[:, i, j, None], out=gap)
            np.multiply(gap, gap, out=gap)
            far += gap
        if i:
            # Numbers grow, so the last centre that was nearer has the largest one.
            np.maximum(own, (far < least) * own.dtype.type(i), out=own)
            np.minimum(least, far, out=least)
        else:
            least[:] = far
    return least, own


def seeds(
    points: DataFrame,
    cols: Sequence[str],
    ks: Iterable[int],
    key: Sequence[str] = (),
    seed: int = SEED,
    rounds: int = ROUNDS,
    oversample: float = OVERSAMPLE,
    weight: str | None = None,
    packed: DataFrame | None = None,
) -> dict[int, list[tuple[float, ...]]]:
    """Starting centres of each k, from candidates that are drawn once for all of them.

    The first candidate is the row of lowest rank. In each round a row is drawn if its uniform
    number, its rank in that round, is below ``oversample * k`` times its share of the total
    squared distance to the candidates; so about that many come to the driver, whatever the size
    of the table, and equal rows are drawn together and count as one. Copies share a draw, so a table of
    them gives fewer; if all rounds gave fewer than k, further ones take a weighted row's share as that of
    one row, and draw as many of any table. Rows are then counted by
    their nearest candidate, and the weighted candidates are reduced to k: the heaviest first,
    then always the one with the largest weight times squared distance to those chosen.

    With fewer different rows than k there are fewer centres. A round is two scans, the first
    candidate and the weights are one each; their number does not depend on the weights. ``packed`` are the ``blocks`` of the points, which
    serve the scans that draw nothing.
    """
    ks = sorted(set(ks))
    rows, xs = _coordinates(points, cols, key, weight)
    held = rows.select(*xs, "w") if packed is None else packed
    named = [f"key{j}" for j in range(len(key))]

    def rank(turn: int) -> Column:
        salt = f"{seed}:{turn}:"
        if named:
            return key_rank(named, salt)
        return F.xxhash64(F.lit(salt), *xs).bitwiseAND(F.lit((1 << RANK_BITS) - 1))

    found = rows.agg(F.min(F.struct(rank(0).alias("rank"), *xs)).alias("r")).first()["r"]
    if found is None:
        raise ValueError("no row has all of its columns")
    candidates = [tuple(found[x] for x in xs)]
    wanted, turn = oversample * ks[-1], 0
    while turn < rounds or len(candidates) < ks[-1]:
        turn += 1
        total, most = _total(held, len(xs), candidates, once=turn > rounds)
        if not total:
            break
        ranked = rows.select(*xs, F.lit(1.0).alias("w"), rank(turn).alias("rank"))
        # No row is farther than the farthest, so what this leaves out would not be drawn; few ranks reach the worker.
        ranked = ranked.where(F.col("rank") < wanted / total * most * (1 + 1e-9) * float(1 << RANK_BITS))
        fresh = {tuple(r) for r in _drawn(ranked, xs, candidates, wanted / total).distinct().collect()}
        candidates += sorted(fresh - {*candidates})
    weights = dict.fromkeys(range(len(candidates)), 0)
    weights.update({r["c"]: r["n"] for r in _collected(step(held, xs, {0: candidates}, "w"), held)})
    return {k: _reduce(candidates, [float(weights[i]) for i in range(len(candidates))], k) for k in ks}


def _total(rows: DataFrame, d: int, candidates: Centers, once: bool = False) -> tuple[float, float]:
    """The sum of the squared distances of all rows to their nearest candidate, with ``once`` whatever they weigh, and the largest one."""
    at = np.array(candidates, np.float64)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, most = 0.0, 0.0
        for batch in batches:
            if BLOCK in batch.schema.names:
                if once:
                    held = _unpacked(batch.column(0), d + 1)
                    held[-1] = held[-1] > 0
                    batch = _packed(held)
                sums = np.zeros((d + 3, len(at)))
                most = max(most, _added(batch, d, at, [0, len(at)], sums))
                total += float(sums[1].sum())
                continue
            for _, weight, far in _distances(batch, d, at):
                least = far.min(axis=0)
                total += float(least @ (weight > 0 if once else weight))
                most = max(most, float(least.max(initial=0.0)))
        yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([most])], names=["far", "most"])

    found = _collected(rows.mapInArrow(add, "far double, most double").agg(F.sum("far"), F.max("most")), rows)[0]
    return found[0] or 0.0, found[1] or 0.0


def _drawn(ranked: DataFrame, xs: list[str], candidates: Centers, rate: float) -> DataFrame:
    """The rows whose rank, as a share of all ranks, is below ``rate`` times their squared distance."""
    at, d, names = np.array(candidates, np.float64), len(xs), list(xs)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = [f.min(axis=0) for *_, f in _distances(batch, d, at)]
            if far:
                taken = batch.column(d + 1).to_numpy() < rate * float(1 << RANK_BITS) * np.concatenate(far)
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(taken)) for c in batch.columns[:d]], names=names)

    return ranked.mapInArrow(draw, ranked.select(*xs).schema)


def _reduce(candidates: list[tuple[float, ...]], weights: list[float], k: int) -> list[tuple[float, ...]]:
    """The ``k`` candidates that are heavy and far from each other; ties go to the first one."""
    at, weight = np.array(candidates), np.array(weights)
    chosen = [int(np.argmax(weight))]
    gap = ((at - at[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(k, len(candidates)):
        best = int(np.argmax(weight * gap))
        if weight[best] * gap[best] <= 0:
            break
        chosen.append(best)
        gap = np.minimum(gap, ((at - at[best]) ** 2).sum(axis=1))
    return [candidates[i] for i in chosen]


@dataclass
class Fit:
    """Centres after the last iteration; sizes and cost of the labelling that gave them."""

    centers: list[tuple[float, ...]]
    sizes: list[int]
    cost: float
    iterations: int


@dataclass
class Fits:
    by_k: dict[int, Fit]
    #: Scans of the points: the iterations of the slowest k.
    passes: int


def step(points: DataFrame, cols: Sequence[str], centers: Mapping[int, Centers], weight: str | None = None) -> DataFrame:
    """One iteration of every set of centres: ``k, c, n, cost, sq`` and the new means as ``x0..``.

    ``cost`` is the sum of squared distances to the centre, ``sq`` the mean squared norm.

    A row belongs to its nearest centre, the first one of several. Rows with a null or NaN part
    belong to no cluster and count nowhere.
    """
    rows = _scanned(points, cols, weight)
    d, ks = len(cols), list(centers)
    at = np.array([c for k in ks for c in centers[k]], np.float64).reshape(-1, d)
    ends = np.cumsum([0, *[len(centers[k]) for k in ks]]).tolist()
    names = ["k", "c", "n", "cost", "sq", *[f"s{j}" for j in range(d)]]
    schema = "k int, c int, n long, cost double, sq double, " + ", ".join(f"s{j} double" for j in range(d))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = np.zeros((d + 3, len(at)))
        n, cost, sq, sums = *told[:3], told[3:].T
        for batch in batches:
            if BLOCK in batch.schema.names:
                _added(batch, d, at, ends, told)
                continue
            for part, heavy, far in _distances(batch, d, at):
                norm, parts = np.einsum("ij,ij->j", part, part) * heavy, part * heavy
                for low, high in zip(ends, ends[1:], strict=False):
                    least, own = _nearest(far[low:high])
                    n[low:high] += np.bincount(own, heavy, high - low)
                    cost[low:high] += np.bincount(own, least * heavy, high - low)
                    sq[low:high] += np.bincount(own, norm, high - low)
                    for j in range(d):
                        sums[low:high, j] += np.bincount(own, parts[j], high - low)
        held = np.flatnonzero(n)
        which = np.repeat(ks, np.diff(ends))
        number = np.arange(len(at)) - np.repeat(ends[:-1], np.diff(ends))
        columns = [which.astype(np.int32)[held], number.astype(np.int32)[held], n.astype(np.int64)[held], cost[held], sq[held], *sums[held].T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    told = rows.mapInArrow(add, schema).groupBy("k", "c").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), (F.sum("sq") / F.sum("n")).alias("sq"), *[F.sum(f"s{j}").alias(f"s{j}") for j in range(d)])
    return told.select("k", "c", "n", "cost", "sq", *[(F.col(f"s{j}") / F.col("n")).alias(f"x{j}") for j in range(d)])


def iterate(
    points: DataFrame,
    cols: Sequence[str],
    starts: Mapping[int, Centers],
    max_iter: int = 50,
    tol: float = 1e-4,
    weight: str | None = None,
) -> Fits:
    """Lloyd iterations of all sets of centres; each scan serves every k that still moves.

    A k is done when none of its centres moved farther than ``tol``, or after ``max_iter``
    iterations. A cluster without rows keeps its centre. ``points`` is read once an iteration: give
    it a table on storage, best the ``blocks`` of one.
    """
    fits = {k: Fit([tuple(map(float, c)) for c in at], [0] * len(at), 0.0, 0) for k, at in starts.items()}
    passes, moving = 0, sorted(fits)
    while moving and passes < max_iter:
        passes += 1
        found: dict[int, dict[int, Row]] = {k: {} for k in moving}
        for r in _collected(step(points, cols, {k: fits[k].centers for k in moving}, weight), points):
            found[r["k"]][r["c"]] = r
        still = []
        for k in moving:
            rows, old = found[k], fits[k].centers
            new = [tuple(rows[c][f"x{j}"] for j in range(len(cols))) if c in rows else at for c, at in enumerate(old)]
            sizes = [rows[c]["n"] if c in rows else 0 for c in range(len(new))]
            fits[k] = Fit(new, sizes, sum(r["cost"] for r in rows.values()), passes)
            if any(sum((a - b) ** 2 for a, b in zip(x, y, strict=True)) > tol * tol for x, y in zip(new, old, strict=True)):
                still.append(k)
        moving = still
    return Fits(fits, passes)


def silhouettes(
    points: DataFrame, cols: Sequence[str], center_sets: Mapping[int, Centers], weight: str | None = None
) -> dict[int, float | None]:
    """Squared-Euclidean silhouettes of the nearest-centre labels of several sets of centres.

    Two scans for all sets: the mean distance of x to a cluster is ``|x|^2 + mean|y|^2 - 2 x.mean(y)``,
    so the first gives a row of statistics per cluster, the second the sum of the scores. Rows alone
    in their cluster score 0. Sets with fewer than two clusters that have rows have none.
    """
    stats: dict[int, dict[int, Row]] = {k: {} for k in center_sets}
    for r in _collected(step(points, cols, center_sets, weight), points):
        stats[r["k"]][r["c"]] = r
    ks = [k for k, found in stats.items() if len(found) > 1]
    if not ks:
        return dict.fromkeys(center_sets)
    rows, xs = _scanned(points, cols, weight), [f"x{j}" for j in range(len(cols))]
    d = len(xs)
    at = np.array([c for k in ks for c in center_sets[k]], np.float64).reshape(-1, d)
    ends = np.cumsum([0, *[len(center_sets[k]) for k in ks]]).tolist()
    known = [stats[k].get(c) for k in ks for c in range(len(center_sets[k]))]
    size = np.array([r["n"] if r else 0 for r in known], np.float64)
    # A cluster without rows is infinitely far.
    sq = np.array([r["sq"] if r else np.inf for r in known])
    mean = np.array([[r[x] if r else 0.0 for x in xs] for r in known])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0.0, np.zeros(len(ks))
        for batch in batches:
            if BLOCK in batch.schema.names:
                more, rows_of = _scored(batch, d, at, ends, size, sq, mean)
                sums += more
                n += rows_of
                continue
            for part, heavy, far in _distances(batch, d, at):
                n += heavy.sum()
                to = (np.einsum("ij,ij->j", part, part) + sq[:, None]) - 2 * (mean @ part)
                each = np.arange(len(heavy))
                for i, (low, high) in enumerate(zip(ends, ends[1:], strict=False)):
                    own = low + _nearest(far[low:high])[1]
                    members = size[own]
                    within = to[own, each] * members / np.maximum(members - 1, 1)
                    to[own, each] = np.inf
                    nearest = to[low:high].min(axis=0)
                    widest = np.maximum(within, nearest)
                    counts = (members > 1) & (widest != 0) & (heavy > 0)
                    sums[i] += ((nearest - within)[counts] / widest[counts]) @ heavy[counts]
        yield pa.RecordBatch.from_arrays([pa.array(np.array(ks, np.int32)), pa.array(sums), pa.array(np.full(len(ks), n, np.int64))], names=["k", "s", "n"])

    told = rows.mapInArrow(score, "k int, s double, n long").groupBy("k").agg((F.sum("s") / F.sum("n")).alias("s"))
    found = {r["k"]: r["s"] for r in _collected(told, points)}
    return {k: found.get(k) for k in center_sets}


class Models(Mapping):
    """Fitted models by k, each made when it is first asked for."""

    def __init__(self, ks: Iterable[int], make: Callable[[int], object]):
        self._ks, self._make, self._made = list(ks), make, {}

    def __getitem__(self, k: int):
        if k not in self._ks:
            raise KeyError(k)
        if k not in self._made:
            self._made[k] = self._make(k)
        return self._made[k]

    def __iter__(self):
        return iter(self._ks)

    def __len__(self) -> int:
        return len(self._ks)


def model_of(spark: SparkSession, centers: Centers, vector: str = "features", label: str = "prediction") -> KMeansModel:
    """A model with these centres, which may be saved and put into a pipeline; labels are in its own order.

    Spark ML starts from the rows of a table that has as many rows as clusters, and does not move.
    """
    rows = spark.createDataFrame([([float(v) for v in c],) for c in centers], "v array<double>").coalesce(1)
    rows = rows.select(array_to_vector("v").alias(vector))
    return KMeans(k=len(centers), initMode="random", maxIter=0, seed=SEED, featuresCol=vector, predictionCol=label).fit(rows)
