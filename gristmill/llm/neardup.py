"""Near-duplicates by an inverted join on the coordinates of MinHash signatures.

Documents with equal shingle sets are one node. Each node is posted under its coordinate-value
pairs. A pair of similar nodes agrees in ``MATCHES`` of the ``COORDINATES`` at least, so a node
that shares fewer values with anyone has no partner, and of ``m`` shared values, rarest first, the
first ``m - MATCHES + 1`` are enough to meet every partner: long lists are skipped. Nodes that meet
form families. Within a family, collisions of signatures are counted block against block; pairs
above the threshold that are not linked yet are confirmed on the full sets. No pair leaves a
task unless it is a confirmed link that joins two parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill import scratch
from gristmill.llm.blocks import mix, spaced_lower, starts_of, token_blocks, unpack, window_hashes, word_hashes
from gristmill.llm.components import components

WORDS = 5
PERCENT = 75
COORDINATES = 64
#: A pair at the similarity limit has 48 +- 3.5 equal coordinates; fewer than 32 in about one of a million.
MATCHES = 32
#: Shingles in a block of a family.
ELEMENTS = 1 << 19
_FACTORS = np.random.default_rng(7).integers(1, 1 << 63, COORDINATES, np.uint64) * np.uint64(2) + np.uint64(1)


def _sets(row: dict, wanted: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the documents of a block, sorted in each; and their counts."""
    lens, ids, words = unpack(row["lens"], row["ids"], row["vocab"])
    h = word_hashes(words)[ids] if len(words) else np.zeros(0, np.uint64)
    whole = window_hashes(h, WORDS)
    first = starts_of(lens)
    sets = []
    for k in range(len(lens)) if wanted is None else wanted:
        a, b = first[k], first[k + 1]
        n = b - a
        if n >= WORDS:
            sets.append(np.unique(whole[a : b - WORDS + 1]))
        else:
            sets.append(window_hashes(h[a:b], int(n))[:1] if n else whole[:0])
    counts = np.fromiter(map(len, sets), np.int64, len(sets))
    return np.concatenate(sets) if sets else whole[:0], counts


def _signatures(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row of coordinates per set; empty sets have zeros."""
    out = np.zeros((len(counts), COORDINATES), np.uint32)
    held = np.flatnonzero(counts)
    if len(held):
        heads = starts_of(counts[held])[:-1]
        for k, factor in enumerate(_FACTORS):
            out[held, k] = np.minimum.reduceat((mix(shingles * factor) >> np.uint64(32)).astype(np.uint32), heads)
    return out


def sketches(blocks: DataFrame, key: str) -> DataFrame:
    """Per document: where it is, its key, the size and two hashes of its shingle set, its signature."""
    schema = "block long, nr int, key long, n long, h1 long, h2 long, sig array<int>"
    names = [f.split()[0] for f in schema.split(", ")]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("block", "lens", "ids", "vocab")}
                shingles, counts = _sets(row)
                sig = _signatures(shingles, counts)
                held = np.flatnonzero(counts)
                hashes = np.zeros((2, len(counts)), np.uint64)
                if len(held):
                    heads = starts_of(counts[held])[:-1]
                    hashes[0, held] = np.add.reduceat(mix(shingles + np.uint64(1)), heads)
                    hashes[1, held] = np.bitwise_xor.reduceat(mix(shingles * _FACTORS[0]), heads)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(sig.view(np.int32).ravel()), COORDINATES)
                columns = [
                    pa.array(np.full(len(counts), row["block"])),
                    pa.array(np.arange(len(counts), dtype=np.int32)),
                    batch.column("keys")[i].values,
                    pa.array(counts),
                    *[pa.array(h.view(np.int64)) for h in hashes],
                    flat.cast(pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    keyed = blocks.select("block", F.col(f"`k_{key}`").cast("array<bigint>").alias("keys"), "lens", "ids", "vocab")
    return keyed.mapInArrow(sketch, schema)


def families(nodes: DataFrame) -> DataFrame:
    """``node`` and ``family`` of the nodes that meet another one in a posting list of their prefixes."""
    posts = nodes.select("node", "h1", F.posexplode("sig").alias("k", "v"))
    posts = posts.select("node", "h1", F.expr("shiftleft(cast(k as bigint), 32) | (v & 4294967295)").alias("post"))
    lists = posts.groupBy("post").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = posts.join(lists, "post").groupBy("node", "h1").agg(F.array_sort(F.collect_list(F.struct("size", "post"))).alias("s"))
    prefix = shared.where(F.size("s") >= MATCHES).select("node", F.explode(F.expr(f"slice(s, 1, size(s) - {MATCHES - 1})")).alias("p"))
    prefix = scratch.materialize(prefix.select("node", F.col("p.post").alias("post")), "prefix")
    heads = prefix.groupBy("post").agg(F.min("node").alias("a"))
    edges = prefix.join(heads, "post").where("node > a").select("a", F.col("node").alias("b"))
    found = components(edges)
    roots = found.select(F.col("component").alias("node"), "component").distinct()
    return found.unionByName(roots).withColumnRenamed("component", "family")


def _confirm(group: pa.Table) -> pa.Table:
    """Links of a block with itself or another one that join parts not linked before."""
    node = group.column("node").to_numpy()
    side = group.column("side").to_numpy()
    sets = [np.frombuffer(x.as_py(), np.uint64) for x in group.column("shingles")]
    sig = np.stack([np.frombuffer(x.as_py(), np.uint32) for x in group.column("sig")])
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    same = group.column("lo")[0].as_py() == group.column("hi")[0].as_py()
    flat, first = np.concatenate(sets), starts_of(size)
    part = np.arange(len(node))
    links: list[tuple[int, int]] = []
    for i in range(len(node)):
        # Each pair once: later rows of the same block, or the rows of the other one.
        rest = np.arange(i + 1, len(node)) if same else (np.flatnonzero(side == 1) if side[i] == 0 else part[:0])
        if not len(rest):
            continue
        small, big = np.minimum(size[rest], size[i]), np.maximum(size[rest], size[i])
        rest = rest[(part[rest] != part[i]) & (100 * small >= PERCENT * big)]
        rest = rest[(sig[rest] == sig[i]).sum(axis=1) >= MATCHES]
        if not len(rest):
            continue
        at = np.repeat(first[rest], size[rest]) + np.arange(size[rest].sum()) - np.repeat(starts_of(size[rest])[:-1], size[rest])
        place = np.minimum(np.searchsorted(sets[i], flat[at]), size[i] - 1)
        both = np.add.reduceat((sets[i][place] == flat[at]).astype(np.int64), starts_of(size[rest])[:-1])
        for j in rest[100 * both >= PERCENT * (size[rest] + size[i] - both)].tolist():
            if part[j] != part[i]:
                links.append((int(node[i]), int(node[j])))
                part[part == part[j]] = part[i]
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def links(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """Confirmed links ``a``, ``b`` between nodes: enough to connect all that similar pairs connect."""
    chosen = nodes.join(families(nodes), "node").select("block", F.struct("nr", "node", "family").alias("d"))
    per_block = chosen.groupBy("block").agg(F.collect_list("d").alias("docs"))
    schema = "family long, node long, n long, shingles binary, sig binary"

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                docs = row["docs"]
                shingles, counts = _sets(row, [d["nr"] for d in docs])
                sig, first = _signatures(shingles, counts), starts_of(counts).tolist()
                columns = [
                    pa.array([d["family"] for d in docs], pa.int64()),
                    pa.array([d["node"] for d in docs], pa.int64()),
                    pa.array(counts),
                    pa.array([shingles[a:b].tobytes() for a, b in zip(first, first[1:], strict=False)], pa.binary()),
                    pa.array([s.tobytes() for s in sig], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["family", "node", "n", "shingles", "sig"])

    packed = blocks.select("block", "lens", "ids", "vocab")
    sets = scratch.materialize(packed.join(per_block.hint("shuffle_hash"), "block").mapInArrow(rebuild, schema), "sets")
    sizes = sets.groupBy("family").agg((F.floor(F.sum("n") / ELEMENTS) + 1).alias("parts"))
    dealt = sets.join(sizes, "family").withColumn("own", F.pmod(F.xxhash64("node"), "parts"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    dealt = dealt.select(
        "family",
        F.least("own", "other").alias("lo"),
        F.greatest("own", "other").alias("hi"),
        F.expr("int(own > other)").alias("side"),
        "node",
        "shingles",
        "sig",
    )
    # Dealt anew, as else all pairs of blocks of a family would stay in the task of the family.
    return dealt.repartition("family", "lo", "hi").groupBy("family", "lo", "hi").applyInArrow(_confirm, "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per document row: the key, ``n_shingles``, ``component_id`` and ``kept``.

    Links are pairs of documents whose sets of ``WORDS``-word shingles have a Jaccard similarity of
    ``PERCENT`` hundredths or more, confirmed on the full sets; a shorter text is one shingle. The
    component is the smallest key reachable; the row of that key is kept. Empty and null texts are
    linked with nothing. Keys must be integers; rows with the same key are one node, and rows with
    a null key are kept, linked with nothing, with a null component.
    """
    blocks = scratch.materialize(token_blocks(docs, spaced_lower, text, (key,)), "tokens")
    found = scratch.materialize(sketches(blocks, key), "sketches")
    linked = found.where("n > 0 and key is not null")
    classes = scratch.materialize(linked.groupBy("h1", "h2", "n").agg(F.min("key").alias("node")), "classes")
    nodes = linked.join(classes, ["h1", "h2", "n"]).where("key = node").dropDuplicates(["node", "h1", "h2"])
    nodes = scratch.materialize(nodes.select("node", "block", "nr", "h1", "sig"), "nodes")
    parts = components(links(blocks, nodes))
    rows = found.select("key", "n", "h1", "h2").join(classes, ["h1", "h2", "n"], "left").join(parts, "node", "left")
    label = F.when((F.col("n") > 0), F.coalesce("component", "node")).otherwise(F.col("key"))
    label = F.when(F.col("key").isNotNull(), label)
    return rows.select(
        F.col("key").cast(docs.schema[key].dataType).alias(key),
        F.col("n").alias("n_shingles"),
        label.cast(docs.schema[key].dataType).alias("component_id"),
        F.coalesce(F.col("key") == label, F.lit(True)).alias("kept"),
    )


