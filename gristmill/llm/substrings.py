"""Exact substring deduplication by winnowed seeds that are extended to maximal repeats.

Words are hashed. Of the ``length - SEED + 1`` seeds (runs of ``SEED`` words) in every window of
``length`` words, the one with the smallest hash is its anchor, so equal windows have equal
anchors. Documents meet on anchors; where one is shared, the match is extended to both sides:
each window around it is compared by its full hash, and neighbouring windows join to a maximal
repeat. A word goes if such a window starts in a document with a smaller id too.

What is shuffled is one entry per block of documents and distinct anchor, never one per
occurrence, so a passage in a third of all documents costs one entry a block. Anchors and windows
are dealt to buckets by their hashes; a bucket holds about ``BUCKET`` entries at any input size.
A bucket answers with one bit per entry, in the order in which the block sent them: the block
works its entries out anew, so no hash travels back. Windows are compared by 96 bits: a 64-bit
hash of one set of word hashes and 32 bits of another, independent one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill import scratch
from gristmill.llm.blocks import gaps_of, spaced, starts_of, token_blocks, unpack, window_hashes, word_hashes

LENGTH = 13
SEED = 7
BUCKET = 1 << 20
#: Keys that are null come after all others.
LAST = np.iinfo(np.int64).max


def _windows(row: dict, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, document number, anchor, full hash and check of every window within a document of a block."""
    lens, ids, words = unpack(row["lens"], row["ids"], row["vocab"])
    none = np.zeros(0, np.uint64)
    h, other = (word_hashes(words, seed)[ids] if len(words) else none for seed in (0, 1))
    n = max(0, len(h) - length + 1)
    nr = np.repeat(np.arange(len(lens)), lens)
    inside = np.flatnonzero(nr[:n] == nr[length - 1 :]) if n else np.zeros(0, np.int64)
    seed = min(SEED, length)
    grams = window_hashes(h, seed)
    anchor = np.minimum.reduce([grams[i : i + n] for i in range(length - seed + 1)]) if n else none
    check = (window_hashes(other, length)[inside] >> np.uint64(32)).astype(np.uint32)
    return inside, nr[inside], anchor[inside], window_hashes(h, length)[inside], check


def _keys(row: dict) -> np.ndarray:
    return np.array([LAST if k is None else k for k in row["keys"]], np.int64)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a new value starts in sorted columns."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(np.concatenate([[True], new]))


def _anchor_entries(nr: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct anchors of a block in order, and whether two of its documents have them."""
    order = np.lexsort((nr, anchor))
    anchor, nr = anchor[order], nr[order]
    heads = _runs(anchor)
    last = np.append(heads[1:], len(anchor)) - 1
    return anchor[heads], (nr[last] > nr[heads]).astype(np.uint8) if len(heads) else np.zeros(0, np.uint8)


def _window_entries(window: np.ndarray, check: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct windows of a block in order: hash, check, smallest key; and the number of each window among them."""
    order = np.lexsort((own, check, window))
    heads = _runs(window[order], check[order])
    number = np.empty(len(window), np.int64)
    number[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(window))))
    first = order[heads]
    return window[first], check[first], own[first], number


def _order(buckets: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How entries are dealt: their order by bucket, the buckets, and where each bucket starts and ends."""
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    heads = _runs(bucket[order])
    return order, bucket[order][heads], np.append(heads, len(hashes))


def _dealt(block: int, buckets: int, hashes: np.ndarray, checks: np.ndarray | None, values: np.ndarray) -> pa.RecordBatch:
    """Sorted hashes, their checks and values, cut by bucket: one row each."""
    order, bucket, ends = _order(buckets, hashes)
    cut = list(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))

    def packed(x):
        return pa.array([b"" if x is None else x[order[a:b]].tobytes() for a, b in cut], pa.binary())

    columns = [pa.array(bucket), pa.array(np.full(len(bucket), block)), packed(hashes), packed(checks), packed(values)]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "block", "hashes", "checks", "vals"])


def _gather(group: pa.Table, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All entries of a bucket: hash, check, value, the order that sorts them, and where each distinct one starts."""
    h, c, v = (
        np.concatenate([np.frombuffer(x.as_py(), t) for x in group.column(name)])
        for name, t in (("hashes", np.uint64), ("checks", np.uint32), ("vals", kind))
    )
    if not len(c):
        c = np.zeros(len(h), np.uint32)
    order = np.lexsort((c, h))
    return h, c, v, order, _runs(h[order], c[order])


def _returned(group: pa.Table, flags: np.ndarray) -> pa.Table:
    """A bit per entry, handed back to the blocks."""
    sizes = [len(x.as_py()) // 8 for x in group.column("hashes")]
    ends = np.cumsum(sizes)[:-1]
    bits = [np.packbits(x).tobytes() for x in np.split(flags, ends)]
    return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "bits": pa.array(bits, pa.binary())})


def _flags(buckets: int, hashes: np.ndarray, back: list[dict] | None) -> np.ndarray:
    """The answers to a block's entries, in the order of the entries."""
    order, bucket, ends = _order(buckets, hashes)
    bits = {x["bucket"]: x["bits"] for x in back or ()}
    out = np.zeros(len(hashes), bool)
    for k, a, b in zip(bucket.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        out[order[a:b]] = np.unpackbits(np.frombuffer(bits[k], np.uint8), count=b - a).astype(bool)
    return out


_ENTRY = "bucket long, block long, hashes binary, checks binary, vals binary"
_BACK = "block long, bucket long, bits binary"


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].as_py() for c in names}


def _back(df: DataFrame, name: str) -> DataFrame:
    """Per block, what its buckets returned."""
    return df.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias(name))


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, keep: tuple[str, ...] = (), gaps: bool = False) -> DataFrame:
    """Every document row with the words left after deduplication.

    Columns: the key, those in ``keep``, ``n_words``, ``n_removed`` and ``kept``. A word is removed
    if a window of ``length`` words over it also starts in a document with a smaller key; windows
    are judged on the input. ``kept`` joins the kept words by one space; with ``gaps`` it is the
    original text without the removed words and the white space after each.

    The key must be an integer or cast to one. Null text has no words. A null key counts as larger than all others. Rows with the same key
    are not repeats of each other. Documents shorter than ``length`` lose nothing. Columns in
    ``keep`` must not have the name of a result.
    """
    if {*keep} & {key, "n_words", "n_removed", "kept"}:
        raise ValueError("a kept column has the name of a result")
    blocks = scratch.materialize(token_blocks(docs, spaced, text, (key, *keep), gaps), "tokens")
    tokens = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    buckets = tokens // 4 // BUCKET + 1
    source = blocks.select("block", F.col(f"`k_{key}`").cast("array<bigint>").alias("keys"), "lens", "ids", "vocab")
    names = ["block", "keys", "lens", "ids", "vocab"]

    def anchors(batches):
        for row in _rows(batches, names):
            _, nr, anchor, _, _ = _windows(row, length)
            if len(anchor):
                hashes, many = _anchor_entries(nr, anchor)
                yield _dealt(row["block"], buckets, hashes, None, many)

    def shared(group: pa.Table) -> pa.Table:
        _, _, many, order, heads = _gather(group, np.uint8)
        counts = np.diff(np.append(heads, len(order)))
        flags = np.empty(len(order), bool)
        flags[order] = np.repeat((counts > 1) | (many[order][heads] > 0), counts)
        return _returned(group, flags)

    def around(row: dict):
        """The windows of a block on shared anchors: start, key, number among the distinct ones, and those."""
        start, nr, anchor, window, check = _windows(row, length)
        hashes, _ = _anchor_entries(nr, anchor)
        known = hashes[_flags(buckets, hashes, row["met"])]
        at = np.minimum(np.searchsorted(known, anchor), max(0, len(known) - 1))
        met = known[at] == anchor if len(known) else np.zeros(len(anchor), bool)
        own = _keys(row)[nr[met]]
        *entries, number = _window_entries(window[met], check[met], own)
        return start[met], own, number, entries

    def extend(batches):
        for row in _rows(batches, [*names, "met"]):
            *_, entries = around(row)
            if len(entries[0]):
                yield _dealt(row["block"], buckets, *entries)

    def smallest(group: pa.Table) -> pa.Table:
        _, _, own, order, heads = _gather(group, np.int64)
        least = np.repeat(np.minimum.reduceat(own[order], heads), np.diff(np.append(heads, len(order))))
        flags = np.empty(len(order), bool)
        flags[order] = least < own[order]
        return _returned(group, flags)

    found = source.mapInArrow(anchors, _ENTRY).groupBy("bucket").applyInArrow(shared, _BACK)
    found = scratch.materialize(_back(found, "met"), "shared")
    windows = source.join(found.hint("shuffle_hash"), "block").mapInArrow(extend, _ENTRY)
    late = windows.groupBy("bucket").applyInArrow(smallest, _BACK)
    answers = scratch.materialize(found.join(_back(late, "late"), "block", "left"), "firsts")

    kinds = [blocks.schema[f"k_{c}"] for c in (key, *keep)]
    schema = T.StructType(
        [T.StructField(f.name[2:], f.dataType.elementType) for f in kinds]
        + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]
    )

    def cut(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in [*names, "met", "late", *["gaps"] * gaps]}
                lens, ids, words = unpack(row["lens"], row["ids"], row["vocab"])
                gone = np.zeros(len(ids) + 1, np.int64)
                if row["met"]:
                    start, own, number, entries = around(row)
                    elsewhere = _flags(buckets, entries[0], row["late"])[number]
                    at = start[elsewhere | (entries[2][number] < own)]
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + length, -1)
                stay = np.cumsum(gone)[:-1] == 0
                first = starts_of(lens)
                kept_before = starts_of(stay)
                n_kept = kept_before[first[1:]] - kept_before[first[:-1]]
                spaces = gaps_of(row["gaps"]) if gaps else None
                texts = []
                for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
                    own_words = map(words.__getitem__, ids[a:b].tolist())
                    if gaps:
                        pairs = map(b"".join, zip(own_words, spaces[k][1:], strict=False))
                        whole = spaces[k][0] + b"".join(compress(pairs, stay[a:b].tolist()))
                    else:
                        whole = b" ".join(compress(own_words, stay[a:b].tolist()))
                    texts.append(whole.decode("utf-8", "replace"))
                columns = [batch.column(f.name)[i].values for f in kinds]
                columns += [pa.array(lens), pa.array(lens - n_kept), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    whole = blocks.select("block", *[f"`{f.name}`" for f in kinds if f.name != "keys"], F.col(f"`k_{key}`").cast("array<bigint>").alias("keys"), "lens", "ids", "vocab", *["gaps"] * gaps)
    return whole.join(answers.hint("shuffle_hash"), "block", "left").mapInArrow(cut, schema)
