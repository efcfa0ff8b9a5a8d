"""Near-duplicate vectors by tiled comparison in the order of principal components.

Equal vectors of a label are one class. Classes are turned to their principal components, sorted by
label and first component and packed to blocks of ``ELEMENTS`` numbers. Tiles of blocks multiply the
leading components first; what the rest can add to a cosine is bounded by the product of the norms
of the two suffixes, so a pair is given up as soon as it cannot reach the threshold, and pairs that
get through are decided by the cosine of the vectors themselves in double precision. Blocks whose
ranges of the first component are farther apart than linked vectors can be are never paired.

A block is compared with itself where it is packed; other pairs of blocks of a label are joined, a
block being one row. No pair of vectors leaves a task: it returns the number of links of each class
and, for each part of a block that is connected already, one edge to what it is linked with.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import PCA, Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill import scratch
from gristmill.functions import quoted
from gristmill.llm.components import components
from gristmill.llm.vectors import matrix, runs_of, usable

THRESHOLD = 0.98
#: Numbers in a block, and blocks in a task that packs them.
ELEMENTS = 1 << 18
BLOCKS = 4
#: Rows of a tile, and the components after which a pair may be given up.
TILE = 512
STEPS = (8, 16, 32, 64, 128, 256, 512, 1024)
#: What rounding may take from a bound; the decision itself has none.
SLACK = 1e-9


def _units(rows: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision, whatever the size of their components."""
    rows = rows.astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


class _Block:
    """Unit vectors, their principal components, and the norms of what follows each step."""

    def __init__(self, rows: np.ndarray, basis: np.ndarray | None):
        self.unit = _units(rows)
        self.turned = self.unit if basis is None else self.unit @ basis
        d = self.unit.shape[1]
        self.steps = [*[s for s in STEPS if s < d], d]
        self.rest = [np.sqrt(np.einsum("ij,ij->i", self.turned[:, s:], self.turned[:, s:])) for s in self.steps]


def _linked(a: _Block, b: _Block, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``a`` and ``b`` with a cosine of at least the threshold, tile by tile; of ``a`` with itself each pair once."""
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    for i in range(0, len(a.unit), TILE):
        for j in range(i if a is b else 0, len(b.unit), TILE):
            p, q = a.turned[i : i + TILE], b.turned[j : j + TILE]
            # Rows are sorted by the first component.
            if q[0, 0] - p[-1, 0] > reach or p[0, 0] - q[-1, 0] > reach:
                continue
            so_far = np.zeros((len(p), len(q)))
            alive = np.triu(np.ones(so_far.shape, bool), 1) if a is b and i == j else np.ones(so_far.shape, bool)
            done = 0
            for step, rest_a, rest_b in zip(a.steps, a.rest, b.rest, strict=True):
                so_far += p[:, done:step] @ q[:, done:step].T
                alive &= so_far + rest_a[i : i + TILE, None] * rest_b[None, j : j + TILE] >= threshold - SLACK
                done = step
                if np.count_nonzero(alive) < alive.size // 16:
                    break
            x, y = np.nonzero(alive)
            value = so_far[x, y]
            for step, rest_a, rest_b in zip(a.steps, a.rest, b.rest, strict=True):
                if step <= done or not len(x):
                    continue
                value += np.einsum("ij,ij->i", p[x, done:step], q[y, done:step])
                may = value + rest_a[i + x] * rest_b[j + y] >= threshold - SLACK
                x, y, value, done = x[may], y[may], value[may], step
            x, y = x + i, y + j
            for low in range(0, len(x), 1 << 16):
                u, v = x[low : low + (1 << 16)], y[low : low + (1 << 16)]
                sure = np.einsum("ij,ij->i", a.unit[u], b.unit[v]) >= threshold
                yield u[sure], v[sure]


def _join(part: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Parts after joining those of ``x`` and ``y``; a part is named by its smallest member."""
    while len(x):
        one, other = part[x], part[y]
        apart = one != other
        x, y, one, other = x[apart], y[apart], one[apart], other[apart]
        to = np.arange(len(part))
        np.minimum.at(to, np.maximum(one, other), np.minimum(one, other))
        while (on := to[to] != to).any():
            to[on] = to[to[on]]
        part = to[part]
    return part


_PACKED = "label long, dim int, block long, low double, high double, ids binary, nodes binary, copies binary, vectors binary, parts binary, links binary"
_FOUND = "kind int, x long, y long"


def _basis(classes: DataFrame) -> tuple[int, np.ndarray | None]:
    """The commonest length of vectors, and its principal components as columns (None below two rows)."""
    most = classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    if most is None or most["n"] < 2:
        return 0, None
    rows = classes.where(F.col("dim") == most["dim"]).select(array_to_vector(F.col("v").cast("array<double>")).alias("v"))
    rows = Normalizer(inputCol="v", outputCol="u").transform(rows)
    found = PCA(k=most["dim"], inputCol="u", outputCol="turned").fit(rows).pc.toArray()
    # Any orthonormal basis gives right results; the first components come first in this one.
    return most["dim"], np.linalg.qr(found)[0]


def near_vectors(
    rows: DataFrame, vector: str = "embedding", label: str = "label", key: str = "vec_id", threshold: float = THRESHOLD, elements: int = ELEMENTS
) -> DataFrame:
    """Per row: the key, ``n_links``, ``component_id`` and ``kept``.

    Two rows of an equal label, neither null, are linked if the cosine of their vectors in double
    precision is at least ``threshold`` (above 0). ``n_links`` counts the other rows linked
    directly, equal vectors included; the component is the smallest key reachable, and the row of
    that key is kept. Keys and labels are integers.

    Vectors that are null, empty or zero, that hold null or something not finite, and vectors of
    different lengths link with nothing; so do rows with a null key, which are kept and have a null
    component. Rows with the same key are one node but have links of their own. Other columns are
    not read.
    """
    if threshold <= 0:
        raise ValueError("the threshold is a positive cosine")
    v = F.transform(F.col(quoted(vector)), lambda x: x + F.lit(0).cast(rows.schema[vector].dataType.elementType))
    whole = rows.select(F.col(quoted(key)).cast("long").alias("key"), F.col(quoted(label)).cast("long").alias("label"), v.alias("v"))
    takes_part = usable(F.col("v")) & F.exists("v", lambda x: x != 0) & F.col("label").isNotNull() & F.col("key").isNotNull()
    whole = whole.withColumn("v", F.when(takes_part, F.col("v")))
    classes = whole.where("v is not null").groupBy("label", "v").agg(F.min("key").alias("node"), F.count(F.lit(1)).alias("copies"))
    classes = classes.select("*", F.size("v").alias("dim"), F.monotonically_increasing_id().alias("id"))
    classes = scratch.materialize(classes, "classes")
    dim, basis = _basis(classes)
    kind = np.float32 if rows.schema[vector].dataType.elementType.typeName() == "float" else np.float64

    def load(vectors: np.ndarray) -> _Block:
        return _Block(vectors, basis if vectors.shape[1] == dim else None)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            first = np.empty(batch.num_rows)
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d)
                units = _units(matrix(batch.column(5).take(pa.array(at))))
                first[at] = units @ basis[:, 0] if d == dim else units[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first)], names=[*batch.schema.names, "first"])

    columns = ["label", "dim", "id", "node", "copies", "v"]
    kinds = classes.select(*columns).schema
    turned = classes.select(*columns).mapInArrow(turn, kinds.add("first", "double"))
    order = ["label", "dim", "first", "id"]
    n_numbers = classes.agg(F.sum(F.col("dim").cast("long"))).first()[0] or 0
    tasks = min(n_numbers // (elements * BLOCKS) + 1, 1 << 16)
    placed = turned.repartitionByRange(tasks, *order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            d = max(1, int(batch.column(1).to_numpy().max(initial=1)))
            for low, high in runs_of(batch, (0, 1), max(1, elements // d)):
                part = batch.slice(low, high - low)
                vectors = matrix(part.column(5))
                block = load(vectors)
                copies = part.column(4).to_numpy()
                parts, links = np.arange(high - low), copies - 1
                for x, y in _linked(block, block, threshold):
                    np.add.at(links, x, copies[y])
                    np.add.at(links, y, copies[x])
                    parts = _join(parts, x, y)
                values = [
                    part.column(0)[0].as_py(),
                    part.column(1)[0].as_py(),
                    number,
                    part.column(6)[0].as_py(),
                    part.column(6)[-1].as_py(),
                    *[part.column(c).to_numpy().astype(np.int64).tobytes() for c in (2, 3, 4)],
                    vectors.astype(kind).tobytes(),
                    parts.astype(np.int32).tobytes(),
                    links.astype(np.int64).tobytes(),
                ]
                number += 1
                yield pa.RecordBatch.from_pylist([dict(zip(_PACKED_NAMES, values, strict=True))], schema=_PACKED_TYPES)

    blocks = scratch.materialize(placed.mapInArrow(pack, _PACKED), "blocks")

    def unpack(row: dict, side: str) -> tuple[_Block, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        numbers = [np.frombuffer(row[f"{c}_{side}"], np.int64) for c in ("ids", "nodes", "copies")]
        vectors = np.frombuffer(row[f"vectors_{side}"], kind).reshape(len(numbers[0]), -1)
        return load(vectors), *numbers, np.frombuffer(row[f"parts_{side}"], np.int32)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, right = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if row["b"] != last:
                    last, right = row["b"], unpack(row, "b")
                left = unpack(row, "a")
                (one, ids, nodes, copies, parts), (two, ids_2, nodes_2, copies_2, parts_2) = left, right
                met, met_2 = np.zeros(len(ids), np.int64), np.zeros(len(ids_2), np.int64)
                # Parts of both blocks; what is connected inside a block is known already.
                joined = np.arange(len(ids) + len(ids_2))
                for x, y in _linked(one, two, threshold):
                    np.add.at(met, x, copies_2[y])
                    np.add.at(met_2, y, copies[x])
                    joined = _join(joined, parts[x].astype(np.int64), parts_2[y].astype(np.int64) + len(ids))
                of = np.concatenate([nodes, nodes_2])
                moved = np.flatnonzero(joined != np.arange(len(joined)))
                counts, counts_2 = np.flatnonzero(met), np.flatnonzero(met_2)
                x = np.concatenate([ids[counts], ids_2[counts_2], of[moved]])
                y = np.concatenate([met[counts], met_2[counts_2], of[joined[moved]]])
                what = np.repeat([0, 1], [len(counts) + len(counts_2), len(moved)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(what), pa.array(x), pa.array(y)], names=["kind", "x", "y"])

    # Blocks are numbered in their sort order, so of a pair the second one begins where the first ends, or later.
    ends = blocks.select("label", "dim", "block", "low", "high")
    a, b = ends.select("label", "dim", F.col("block").alias("a"), "high"), ends.select("label", "dim", F.col("block").alias("b"), "low")
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    pairs = a.join(b, ["label", "dim"]).where((F.col("a") < F.col("b")) & (F.col("low") - F.col("high") <= reach)).select("a", "b")
    side = ["ids", "nodes", "copies", "vectors", "parts"]
    left, right = (blocks.select(F.col("block").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in side]) for s in "ab")
    spread = min(max(1, blocks.count()), 1 << 16)
    both = pairs.join(left.hint("shuffle_hash"), "a").repartition(spread, "b").join(right.repartition(spread, "b").hint("shuffle_hash"), "b")
    found = scratch.materialize(both.mapInArrow(compare, _FOUND), "links")

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, nodes, links = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("ids", "nodes", "links"))
                parts = np.frombuffer(batch.column("parts")[i].as_py(), np.int32)
                moved = np.flatnonzero(parts != np.arange(len(parts)))
                what = np.repeat([0, 1], [len(ids), len(moved)]).astype(np.int32)
                x, y = np.concatenate([ids, nodes[moved]]), np.concatenate([links, nodes[parts[moved]]])
                yield pa.RecordBatch.from_arrays([pa.array(what), pa.array(x), pa.array(y)], names=["kind", "x", "y"])

    told = blocks.select("ids", "nodes", "parts", "links").mapInArrow(own, _FOUND).unionByName(found)
    counts = told.where("kind = 0").groupBy(F.col("x").alias("id")).agg(F.sum("y").alias("n_links"))
    marks = [F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")]
    of_class = scratch.materialize(classes.select("label", *marks, "node", "id").join(counts, "id").drop("id"), "classes")
    marked = whole.select("key", F.when(F.col("v").isNotNull(), F.col("label")).alias("label"), *marks)
    labelled = scratch.materialize(marked.join(of_class, ["label", "h1", "h2"], "left").select("key", "node", "n_links"), "members")
    # A key with vectors of several classes connects them.
    several = labelled.where("node is not null").select("key", "node").distinct()
    least = several.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x < y")
    repeated = several.join(least.select("key", "x"), "key").select("x", F.col("node").alias("y"))
    edges = told.where("kind = 1").select("x", "y").unionByName(repeated)
    parts = components(edges, "x", "y")
    component = F.coalesce("component", "node", "key")
    return labelled.join(parts, "node", "left").select(
        F.col("key").cast(rows.schema[key].dataType).alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.cast(rows.schema[key].dataType).alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"),
    )


_PACKED_NAMES = [c.split()[0] for c in _PACKED.split(", ")]
_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
_PACKED_TYPES = pa.schema([(c.split()[0], _ARROW[c.split()[1]]) for c in _PACKED.split(", ")])
