"""Hard negatives by best-first search in STR-packed R-trees.

Vectors are sorted by label and packed to trees of at most ``ELEMENTS`` numbers, each of one label.
A tree is sort-tile-recursive: rows are cut to slabs along one coordinate after the other until a
slab is a leaf, and neighbouring leaves share a parent; every node has its minimum bounding box. An
anchor's coordinate times a box's interval is an interval, and their sum bounds all inner products
in the box. A queue takes the box with the highest bound first. It drops boxes outside the score
windows and those strictly below the k-th score found, and ends when the best box left is below.

Anchors travel in blocks to the trees of their label, which gives the positives, and then with the
windows of these to the trees of all other labels. Per anchor and tree a handful of rows come back.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill import scratch
from gristmill.functions import quoted
from gristmill.llm.vectors import matrix, runs_of, usable

#: Numbers in a tree, trees in a task that packs them, and anchors that travel together.
ELEMENTS = 1 << 20
TREES = 2
ANCHORS = 1024
#: Rows of a leaf and children of a node.
LEAF = 256
FAN = 16
#: Inner products are exact up to here.
EXACT = 1 << 53


def str_order(rows: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Sort-tile-recursive order: consecutive ``leaf`` rows are a leaf page."""
    d = rows.shape[1]
    done: list[np.ndarray] = []
    left = [(np.arange(len(rows)), 0)]
    while left:
        at, k = left.pop()
        pages = -(-len(at) // leaf)
        if pages <= 1 or k == d:
            done.append(at)
            continue
        at = at[np.argsort(rows[at, k], kind="stable")]
        slabs = math.ceil(pages ** (1 / (d - k)) - 1e-9)
        size = -(-pages // slabs) * leaf
        # The last slab is pushed first, so that the first one is taken next.
        left += [(at[low : low + size], k + 1) for low in range(0, len(at), size)][::-1]
    return np.concatenate(done) if done else np.zeros(0, np.int64)


class Tree:
    """Rows in packed order and the boxes of every level, leaves first; children are neighbours."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray, leaf: int = LEAF, fan: int = FAN):
        self.keys, self.rows, self.leaf, self.fan = keys, rows, leaf, fan
        heads = np.arange(0, len(rows), leaf)
        self.boxes = [(np.minimum.reduceat(rows, heads), np.maximum.reduceat(rows, heads))]
        while len(self.boxes[-1][0]) > fan:
            low, high = self.boxes[-1]
            heads = np.arange(0, len(low), fan)
            self.boxes.append((np.minimum.reduceat(low, heads), np.maximum.reduceat(high, heads)))

    def bounds(self, anchors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per level the least and the largest inner product of each anchor with a row of each box."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return [(up @ low.T + down @ high.T, up @ high.T + down @ low.T) for low, high in self.boxes]

    def search(self, anchor: np.ndarray, bounds: list[tuple[np.ndarray, np.ndarray]], floors: np.ndarray, caps: np.ndarray, k: int, own: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each score window ``floors[w] <= score <= caps[w]`` its first ``k`` scores and rows, without key ``own``.

        ``bounds`` are those of this anchor. Higher scores come first, ties by smaller key.
        """
        floors = floors.copy()
        found = [(np.zeros(0), np.zeros(0, np.int64)) for _ in floors]
        top = len(self.boxes) - 1
        queue: list[tuple[float, int, int]] = []

        def push(level: int, nodes: np.ndarray) -> None:
            least, most = bounds[level][0][nodes], bounds[level][1][nodes]
            open_ = ((most[:, None] >= floors) & (least[:, None] <= caps)).any(axis=1)
            for node, bound in zip(nodes[open_].tolist(), most[open_].tolist(), strict=True):
                heapq.heappush(queue, (-bound, level, node))

        push(top, np.arange(len(self.boxes[top][0])))
        while queue:
            bound, level, node = heapq.heappop(queue)
            if -bound < floors.min():
                break
            if level:
                push(level - 1, np.arange(node * self.fan, min((node + 1) * self.fan, len(self.boxes[level - 1][0]))))
                continue
            low = node * self.leaf
            scores = self.rows[low : low + self.leaf] @ anchor
            hits = (scores >= floors[:, None]) & (scores <= caps[:, None]) & (self.keys[low : low + self.leaf] != own)
            for w in np.flatnonzero(hits.any(axis=1)).tolist():
                at = np.flatnonzero(hits[w])
                value, row = np.concatenate([found[w][0], scores[at]]), np.concatenate([found[w][1], at + low])
                first = np.lexsort((self.keys[row], -value))[:k]
                found[w] = value[first], row[first]
                if len(first) == k:
                    # A tie with the k-th score may still win by its key.
                    floors[w] = max(floors[w], value[first[-1]])
        return found


_TREE = "label long, dim int, block long, keys binary, vectors binary"
_ARROW = pa.schema([("label", pa.int64()), ("dim", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("vectors", pa.binary())])
_HIT = "a long, nr int, anchor long, other long, score long"
_HIT_NAMES = [c.split()[0] for c in _HIT.split(", ")]


def _packed(rows: DataFrame, order: list[str], tasks: int, elements: int, most: int | None, leaf: int | None) -> DataFrame:
    """Sorted rows of a label and length as blocks of keys and vectors; with ``leaf`` in the order of a tree."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            d = max(1, int(batch.column(1).to_numpy().max(initial=1)))
            for low, high in runs_of(batch, (0, 1), min(most or elements, max(1, elements // d))):
                part = batch.slice(low, high - low)
                keys, vectors = part.column(2).to_numpy(), matrix(part.column(3))
                if leaf:
                    by = str_order(vectors, leaf)
                    keys, vectors = keys[by], vectors[by]
                row = {"label": part.column(0)[0].as_py(), "dim": vectors.shape[1], "block": number, "keys": keys.tobytes(), "vectors": vectors.astype(np.int32).tobytes()}
                number += 1
                yield pa.RecordBatch.from_pylist([row], schema=_ARROW)

    keys = ["label", "dim", *order]
    placed = rows.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    return placed.select("label", "dim", "key", "v").mapInArrow(pack, _TREE)


def _search(anchors: DataFrame, trees: DataFrame, same: bool, k: int, leaf: int) -> DataFrame:
    """The first ``k`` rows of each anchor, window and tree of its label, or of any other label.

    ``anchors`` may have ``windows``, of an array of ``nr`` and positive ``score``; without them
    every score will do.
    """
    windowed = "windows" in anchors.columns

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tree = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if row["b"] != last:
                    last = row["b"]
                    keys = np.frombuffer(row["tree_keys"], np.int64)
                    tree = Tree(keys, np.frombuffer(row["tree_vectors"], np.int32).reshape(len(keys), -1).astype(np.float64), leaf)
                keys = np.frombuffer(row["keys"], np.int64)
                vectors = np.frombuffer(row["vectors"], np.int32).reshape(len(keys), -1).astype(np.float64)
                caps: list[list[float]] = [[] if windowed else [math.inf] for _ in keys]
                for w in row["windows"] if windowed else ():
                    if w["score"] >= 0:  # a window below zero is empty
                        caps[w["nr"]].append(w["score"])
                bounds = tree.bounds(vectors)
                nrs, others, scores = [], [], []
                for nr, own in enumerate(keys.tolist()):
                    if not caps[nr]:
                        continue
                    highest = np.unique(np.array(caps[nr], np.float64))
                    # 80 p <= 100 s, in whole numbers
                    floors = -((-4 * highest) // 5) if windowed else np.array([-math.inf])
                    found = tree.search(vectors[nr], [(x[nr], y[nr]) for x, y in bounds], floors, highest, k, own)
                    at, first = np.unique(np.concatenate([r for _, r in found]), return_index=True)
                    nrs.append(np.full(len(at), nr, np.int32))
                    others.append(tree.keys[at])
                    scores.append(np.concatenate([s for s, _ in found])[first].astype(np.int64))
                if nrs:
                    nr = np.concatenate(nrs)
                    columns = [np.full(len(nr), row["a"]), nr, keys[nr], np.concatenate(others), np.concatenate(scores)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_HIT_NAMES)

    a = anchors.select(F.col("block").alias("a"), "dim", F.col("label").alias("l"))
    b = trees.select(F.col("block").alias("b"), "dim", F.col("label").alias("m"))
    pairs = a.join(b, "dim").where(F.col("l") == F.col("m") if same else F.col("l") != F.col("m")).select("a", "b")
    spread = min(max(1, trees.count()), 1 << 16)
    sent = anchors.select(F.col("block").alias("a"), "keys", "vectors", *["windows"] * windowed)
    sent = pairs.join(sent.hint("shuffle_hash"), "a").repartition(spread, "b")
    packed = trees.select(F.col("block").alias("b"), F.col("keys").alias("tree_keys"), F.col("vectors").alias("tree_vectors"))
    return sent.join(packed.repartition(spread, "b").hint("shuffle_hash"), "b").mapInArrow(look, _HIT)


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    vector: str = "vector",
    label: str = "label",
    key: str = "vec_id",
    positives: int = 5,
    negatives: int = 5,
    elements: int = ELEMENTS,
    leaf: int = LEAF,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vector`` is an array of whole numbers (of any numeric type); a score is an inner product.
    The rows for which ``anchors`` holds are the anchors. Their positives are the first
    ``positives`` other rows of the same label; each anchor and positive has the first
    ``negatives`` rows of other labels with 80 to 100 hundredths of the positive's score, where
    there are any. Higher scores come first, ties by smaller key; ``rank`` counts from 1.

    Rows with a null key, label or vector, with a null or not finite component, an empty vector, or
    a component beyond the square root of 2^53 / length (or of 32 bits; products would not be
    exact) take no part. Vectors are compared with those of their length. Of rows with the same
    key the one with the smallest label and vector takes part. Labels and keys are integers. Other
    columns are not read, except by ``anchors``.
    """
    v = F.col(quoted(vector))
    kept = rows.select(
        F.col(quoted(key)).cast("long").alias("key"), F.col(quoted(label)).cast("long").alias("label"), v.cast("array<double>").alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor")
    ).where(usable(F.col("v")) & F.col("key").isNotNull() & F.col("label").isNotNull())
    limit = F.least(F.floor(F.sqrt(F.lit(EXACT) / F.size("v"))), F.lit((1 << 31) - 1))
    kept = kept.where(F.array_max(F.transform("v", F.abs)) <= limit)
    kept = kept.groupBy("key").agg(F.min(F.struct("label", "v")).alias("r"), F.max("anchor").alias("anchor"))
    kept = kept.select("key", "r.label", F.size("r.v").alias("dim"), "r.v", F.get("r.v", F.lit(0)).alias("first"), "anchor")
    kept = scratch.materialize(kept, "vectors")
    told = kept.agg(F.sum(F.col("dim").cast("long")).alias("n"), F.sum(F.when(F.col("anchor"), F.col("dim").cast("long"))).alias("a")).first()
    tasks = min((told["n"] or 0) // (elements * TREES) + 1, 1 << 16)
    trees = scratch.materialize(_packed(kept, ["first", "key"], tasks, elements, None, leaf), "trees")
    tasks = min((told["a"] or 0) // (elements * TREES) + 1, 1 << 16)
    asked = scratch.materialize(_packed(kept.where("anchor"), ["key"], tasks, elements, ANCHORS, None), "anchors")

    best = Window.partitionBy("a", "nr").orderBy(F.desc("score"), "other")
    near = _search(asked, trees, True, positives, leaf).withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    near = scratch.materialize(near.select("a", "nr", "anchor", F.col("other").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    windows = near.groupBy("a").agg(F.collect_list(F.struct("nr", F.col("positive_score").alias("score"))).alias("windows"))
    asked = scratch.materialize(asked.join(windows.withColumnRenamed("a", "block"), "block"), "windows")
    far = _search(asked, trees, False, negatives, leaf).select("a", "nr", F.col("other").alias("negative_id"), F.col("score").alias("negative_score"))
    fits = (80 * F.col("positive_score") <= 100 * F.col("negative_score")) & (F.col("negative_score") <= F.col("positive_score"))
    ranked = Window.partitionBy("a", "nr", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    mined = near.join(far, ["a", "nr"]).where(fits).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= negatives)
    id_type = rows.schema[key].dataType
    return mined.select(
        F.col("anchor").cast(id_type).alias("anchor_id"),
        F.col("positive_id").cast(id_type).alias("positive_id"),
        "rank",
        F.col("negative_id").cast(id_type).alias("negative_id"),
        "positive_score",
        "negative_score",
    )
