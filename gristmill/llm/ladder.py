"""Symbols scored by the longest retained suffix of what stands before them, over whole tables.

A sequence is a run of symbols (words of a document, characters of a word). A context of length
``L`` is the ``L`` symbols before a symbol. It is a candidate if it was seen ``least`` times in
training, an absolute number, and is retained if its next symbols diverge from those of its suffix
by more than a penalty for their number. Distributions are smoothed with those of the longest
retained suffix.

Lengths go one by one. As a context is itself a gram of the length before, a block of sequences
knows how often each of its contexts was seen, and asks only for those that are candidates: no gram
of a context that passes is left out. A block adds up its grams first and sends one entry per
distinct one to the bucket of the context; the bucket adds up the blocks' entries, tests the
context, and sends counts back to each block. So the tree is spread over buckets, of which there
are as many as the corpus asks for, and no task or the driver ever holds it. Contexts seen more
than ``hot`` times are split over several buckets by the next symbol; there is at most one for each
``hot`` symbols of the corpus, and the sums of their parts go over the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill import scratch
from gristmill.llm.blocks import _M1, expand, mix, starts_of

LEAST = 4
HOT = 1_000_000
#: Entries of a bucket.
BUCKET = 2_000_000
ENTRIES = "bucket long, unit long, contexts binary, grams binary, symbols binary, weights binary, logs binary"
ANSWERS = "bucket long, unit long, n binary, k binary, context long, symbols long, gain double"
BACK = "array<struct<level:int,bucket:bigint,n:binary,k:binary>>"
ONE = np.uint64(1)


def squeezed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def loose(packed: bytes, kind) -> np.ndarray:
    return np.frombuffer(expand(packed), kind)


def _sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of well spread 64-bit keys, the same on every machine, and the keys in it.

    Sorting the high bits with the positions in the low ones is several times faster than sorting
    positions; where different keys share their high bits, which is rare, the positions are sorted.
    """
    low = np.uint64((1 << len(keys).bit_length()) - 1)
    order = (np.sort((keys & ~low) | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)
    held = keys[order]
    if ((held[1:] ^ held[:-1]) - ONE < low).any():
        order = np.argsort(keys, kind="stable")
        return order, keys[order]
    return order, held


def ordered(keys: np.ndarray) -> np.ndarray:
    """The stable order of well spread 64-bit keys."""
    return _sorted(keys)[0]


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A position of each distinct key, in their order, and the number of the key of each position."""
    order, held = _sorted(keys)
    new = np.ones(len(held), bool)
    new[1:] = held[1:] != held[:-1]
    number = np.empty(len(held), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _entropy(n: np.ndarray) -> np.ndarray:
    return n * np.log(np.maximum(n, 1))


def _salted(context: np.ndarray, part: np.ndarray) -> np.ndarray:
    return mix(context ^ mix((part + 1).astype(np.uint64))) | ONE


def _bits(numbers: int) -> int:
    return max(1, (numbers - 1).bit_length())


def _numbered(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, below ``2 ** bits``, in order, and the number of the key of each position.

    Where there are few, a table of all has them. Else keys are sorted with their positions in the low bits,
    which is several times faster than sorting positions.
    """
    low = _bits(len(keys))
    if bits <= low + 3:
        held = np.zeros(1 << bits, bool)
        held[keys] = True
        return np.flatnonzero(held), (np.cumsum(held, dtype=np.int32) - 1)[keys]
    if bits + low < 64:
        held = np.sort(keys << low | np.arange(len(keys)))
        order, held = held & ((1 << low) - 1), held >> low
    else:
        order = np.argsort(keys)
        held = keys[order]
    new = np.ones(len(held), bool)
    new[1:] = held[1:] != held[:-1]
    number = np.empty(len(held), np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - 1
    return held[new], number


class Grams:
    """The distinct grams of one length in a block. Number -1 stands for those that were not asked for.

    ``at`` has the number of the gram that ends at each position, ``hashes`` their hashes, ``n`` their
    training counts, ``sizes`` those of their contexts and, if scored, ``p`` their probabilities.
    """

    def __init__(self, at: np.ndarray, hashes: np.ndarray, n: np.ndarray, sizes: np.ndarray, p: np.ndarray | None):
        self.at, self.hashes, self.p = at, hashes, p
        self.n, self.sizes = np.append(n, 0), np.append(sizes, 0)


class Rung:
    """The distinct grams of one length that a block asks for, by bucket and context."""

    def __init__(self, level: int, below: Grams, ids: np.ndarray, hashes: np.ndarray, room: np.ndarray, least: int, hot: int, buckets: int):
        self.live = np.flatnonzero((below.n >= least)[below.at[:-1]] & (room[1:] >= level)) + 1
        context, symbol = below.at[self.live - 1].astype(np.int64), ids[self.live]
        #: The grams that contexts are, and the hashes that these are asked for by: parts of split ones come last.
        self.grams, wholes = np.arange(len(below.hashes)), below.hashes & ~ONE
        self.splits: list[tuple[int, int, np.ndarray]] = []
        split = np.flatnonzero(below.n[:-1] >= hot)
        if len(split):
            parts = below.n[split] // hot + 1
            first = len(wholes) + starts_of(parts)
            of = np.repeat(split, parts)
            self.grams = np.concatenate([self.grams, of])
            wholes = np.concatenate([wholes, _salted(wholes[of], np.arange(len(of)) - np.repeat(first[:-1] - first[0], parts))])
            self.splits = list(zip(split.tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True))
            number = np.full(len(below.hashes), -1)
            number[split] = np.arange(len(split))
            which = number[context]
            moved = np.flatnonzero(which >= 0)
            which = which[moved]
            context[moved] = first[which] + (hashes[symbol[moved]] % parts[which].astype(np.uint64)).astype(np.int64)
        of = ((wholes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        order = np.argsort(of.astype(np.uint16) if buckets <= 1 << 16 else of, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        low = _bits(len(hashes))
        keys, self.entry = _numbered(rank[context] << low | symbol, _bits(len(order)) + low)
        #: By entry: the symbol, and the number of the context.
        self.symbols = keys & ((1 << low) - 1)
        ranks = keys >> low
        new = np.ones(len(keys), bool)
        new[1:] = ranks[1:] != ranks[:-1]
        self.context = np.cumsum(new) - 1
        #: By context, in order of buckets: where its entries start, its number among ``wholes``, hash and bucket.
        self.starts = np.flatnonzero(new)
        self.number = order[ranks[new]]
        self.wholes, self.contexts, self.of = wholes, wholes[self.number], of[self.number]
        self.size = below.n[self.grams[self.number]]
        self.below, self.hashes, self.buckets = below, hashes, buckets

    def of_suffix(self, values: np.ndarray) -> np.ndarray:
        """By entry: the value of the gram without the context's first symbol."""
        out = np.empty(len(self.symbols), values.dtype)
        out[self.entry] = values[self.below.at[self.live]]
        return out

    def ask(self, unit: int, weight: np.ndarray) -> pa.RecordBatch:
        """One row for each bucket."""
        entries = len(self.symbols)
        weights = np.bincount(self.entry, weight[self.live], entries).astype(np.int64)
        share = np.log(np.maximum(self.below.n, 1) / np.maximum(self.below.sizes, 1))
        logs = np.bincount(self.context, weights * self.of_suffix(share), len(self.contexts))
        grams = np.bincount(self.context, minlength=len(self.contexts)).astype(np.int32)
        cut, starts = np.searchsorted(self.of, np.arange(self.buckets + 1, dtype=np.uint64)).tolist(), starts_of(grams)
        low48 = self.hashes[self.symbols].view(np.uint8).reshape(-1, 8)[:, :6]
        rows = []
        for b in range(self.buckets):
            x, y = cut[b], cut[b + 1]
            if x < y:
                i, j = int(starts[x]), int(starts[y])
                rows.append((b, unit, self.contexts[x:y].tobytes(), squeezed(grams[x:y]), low48[i:j].tobytes(), squeezed(weights[i:j]), logs[x:y].astype(np.float32).tobytes()))
        kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 5)
        names = ["bucket", "unit", "contexts", "grams", "symbols", "weights", "logs"]
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], names=names)

    def counted(self, n: np.ndarray, k: np.ndarray | None) -> Grams:
        """The grams, given their counts and, if scored, the numbers of symbols of retained contexts."""
        p = None
        if k is not None:
            p, k = self.of_suffix(self.below.p), k[self.context]
            p = np.where(k > 0, (n + k * p) / (self.size[self.context] + k), p)
        of = self.grams[self.number][self.context]
        at = np.full(len(self.below.at), -1, np.int32)
        at[self.live] = self.entry
        return Grams(at, mix(self.below.hashes[of] * _M1 + self.hashes[self.symbols]), n, self.size[self.context], p)


def _answer(penalty: float) -> Callable[[pa.Table], pa.Table]:
    """Add up a bucket and test its contexts; a context that is not retained has 0 symbols."""

    def answer(group: pa.Table) -> pa.Table:
        col = {c: group.column(c).to_pylist() for c in group.schema.names}
        contexts = [np.frombuffer(x, np.uint64) for x in col["contexts"]]
        grams = [loose(x, np.int32) for x in col["grams"]]
        asked, held = [len(x) for x in contexts], [int(x.sum()) for x in grams]
        raw = np.zeros((sum(held), 8), np.uint8)
        raw[:, :6] = np.frombuffer(b"".join(col["symbols"]), np.uint8).reshape(-1, 6)
        symbol = raw.view(np.uint64).ravel()
        weight = np.concatenate([loose(x, np.int64) for x in col["weights"]] or [np.zeros(0, np.int64)])
        logs = np.frombuffer(b"".join(col["logs"]), np.float32).astype(np.float64)
        asked_for = np.concatenate([*contexts, np.zeros(0, np.uint64)])
        first, which = grouped(asked_for)
        known = asked_for[first]
        sizes = np.concatenate([*grams, np.zeros(0, np.int32)])
        of = np.repeat(which, sizes)
        first, gram = grouped(mix(np.repeat(asked_for, sizes) * _M1 + symbol))
        n = np.bincount(gram, weight, len(first))
        at = of[first]
        k = np.bincount(at, n > 0, len(known)).astype(np.int64)
        size = np.bincount(at, n, len(known))
        gain = np.bincount(at, _entropy(n), len(known)) - np.bincount(which, logs, len(known))
        split = (known & ONE).astype(bool)
        kept = np.where(~split & (gain - _entropy(size) > penalty * k), k, 0)
        counts, symbols = n.astype(np.int64)[gram], kept[which]
        i, j = starts_of(np.array(held, np.int64)).tolist(), starts_of(np.array(asked, np.int64)).tolist()
        rows = len(held)
        parts = np.flatnonzero(split)
        bucket = col["bucket"][0] if rows else 0
        return pa.table(
            {
                "bucket": pa.array([bucket] * (rows + len(parts)), pa.int64()),
                "unit": pa.array([*col["unit"], *[None] * len(parts)], pa.int64()),
                "n": pa.array([*(squeezed(counts[i[r] : i[r + 1]]) for r in range(rows)), *[None] * len(parts)], pa.binary()),
                "k": pa.array([*(squeezed(symbols[j[r] : j[r + 1]]) for r in range(rows)), *[None] * len(parts)], pa.binary()),
                "context": pa.array([*[None] * rows, *known[parts].view(np.int64).tolist()], pa.int64()),
                "symbols": pa.array([*[None] * rows, *k[parts].tolist()], pa.int64()),
                "gain": pa.array([*[None] * rows, *gain[parts].tolist()], pa.float64()),
            }
        )

    return answer


def climb(units: DataFrame, read: Callable, depth: int, total: int, positions: int, finish: Callable, schema: str, least: int = LEAST, hot: int = HOT, root: DataFrame | None = None, dealt: int | None = None, used: list[str] | None = None) -> DataFrame:
    """Blocks of sequences with the probability of each symbol after its longest retained context.

    ``units`` has a column ``unit``. ``read`` takes a row of it, and whether it is scored, and gives per position
    the number of its symbol in the row, how many symbols of its sequence stand before it and its weight in
    training, and per symbol a hash (a well spread 64-bit number), its training count and its probability without a context; asking for counts needs no
    probabilities, so rows that are not scored have none, and ``k`` is null in what they are sent. ``total`` is what all
    training counts add up to, ``positions`` about the number of positions. ``finish`` takes the row
    and the probabilities and gives a batch of ``schema``. ``units`` is read several times; if it is
    bucketed by ``unit``, ``dealt`` is the number of buckets, answers are dealt alike, and no join
    shuffles either side. ``root`` has
    answers that ``read`` and ``finish`` find in the row as level 0. Paths of tables that are not read
    again once the result is written are added to ``used``.
    """
    buckets = positions // BUCKET + 1
    penalty = math.log(max(2, total)) / 2
    names = units.columns
    tables: list[DataFrame] = []
    roots = [] if root is None else [(0, root)]
    heavy: list[dict[int, tuple[int, float]]] = []

    def state(row: dict, levels: int, heavy: list, scored: bool) -> tuple[Callable[[int, Grams], Rung], np.ndarray, Grams, np.ndarray | None]:
        """How to make the next rung, the weights, the grams after ``levels`` lengths and, if ``scored``, the probabilities."""
        ids, room, weight, hashes, n, root = read(row, scored)
        grams = Grams(ids, mix(hashes), n, np.full(len(n), total), root)
        p = root[ids] if scored else None
        back: dict[int, list[dict]] = {}
        for b in row["back"]:
            back.setdefault(b["level"], []).append(b)

        def rung_of(level: int, below: Grams) -> Rung:
            return Rung(level, below, ids, hashes, room, least, hot, buckets)

        for level in range(1, levels + 1):
            rung = rung_of(level, grams)
            found = sorted(back.get(level, ()), key=lambda b: b["bucket"])
            counts = np.concatenate([np.zeros(0, np.int64), *(loose(b["n"], np.int64) for b in found)])
            k = np.concatenate([np.zeros(0, np.int64), *(loose(b["k"], np.int64) for b in found)]) if scored else None
            if scored and rung.splits:
                symbols_of = np.zeros(len(rung.wholes), np.int64)
                symbols_of[rung.number] = k
                for c, first, end in rung.splits:
                    held = [heavy[level - 1][q] for q in rung.wholes[first:end].view(np.int64).tolist() if q in heavy[level - 1]]
                    size, whole = int(grams.n[c]), sum(h[0] for h in held)
                    kept = sum(h[1] for h in held) - size * math.log(size) > penalty * whole
                    symbols_of[first:end] = whole if kept else 0
                k = symbols_of[rung.number]
            grams = rung.counted(counts, k)
            if scored:
                p[rung.live] = grams.p[rung.entry]
        return rung_of, weight, grams, p

    def joined(scored: bool) -> DataFrame:
        out, backs = units, []
        k = F.col("k") if scored else F.lit(None).cast("binary").alias("k")
        for level, table in [*roots, *enumerate(tables, 1)]:
            backs.append(f"back{level}")
            held = F.struct(F.lit(level).alias("level"), "bucket", "n", k)
            back = table.where("unit is not null").groupBy("unit").agg(F.collect_list(held).alias(backs[-1]))
            out = out.join(back.hint("shuffle_hash"), "unit", "left")
        none = F.expr(f"cast(array() as {BACK})")
        return out.select(*names, F.concat(none, *(F.coalesce(b, none) for b in backs)).alias("back"))

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield {c: batch.column(c)[i].as_py() for c in batch.schema.names}

    def asking(level: int, heavy: list):
        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in rows_of(batches):
                rung_of, weight, grams, _ = state(row, level - 1, heavy, False)
                yield rung_of(level, grams).ask(row["unit"], weight)

        return ask

    for level in range(1, depth + 1):
        entries = joined(False).mapInArrow(asking(level, list(heavy)), ENTRIES)
        path = scratch.folder(units.sparkSession, "answers")
        if used is not None:
            used.append(path)
        found = entries.groupBy("bucket").applyInArrow(_answer(penalty), ANSWERS)
        answers = scratch.bucketed(found, "answers", "unit", dealt, path) if dealt else scratch.materialize(found, "answers", path)
        # At most 2 * total / hot rows.
        split = answers.where("unit is null").select("context", "symbols", "gain").collect()
        heavy.append({r[0]: (r[1], r[2]) for r in split})
        tables.append(answers)

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            yield finish(row, state(row, depth, heavy, True)[-1])

    return joined(True).mapInArrow(end, schema)
