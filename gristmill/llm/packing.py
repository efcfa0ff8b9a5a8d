"""Conflict-constrained best-fit packing of documents into bins of fixed capacity.

Items go in order of falling size into the open bin with the smallest residual that holds them and
that has no other document of the same source or duplicate cluster. Bins lie in order of their
residuals; each carries bitmaps of its sources and clusters, and the search goes on to the next
larger residual until a compatible bin is found. Items are dealt at random to shards of about
``SHARD`` tokens, which are packed independently, so work and memory of a task do not depend on
the input; the last bins of a shard are all that sharding wastes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.names import quoted
from gristmill.llm.blocks import texts_of

CAPACITY = 1024
SHARD = 4_000_000


def word_count(text: Column) -> Column:
    """Words of ``[^\\x20\\x09-\\x0D]+``; null has none."""

    @F.arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            raw, _ = texts_of(pa.RecordBatch.from_arrays([column], names=["t"]))
            yield pa.array([len(t.as_py().split()) for t in raw], pa.int64())

    return count(text)


def _bits(values: list[object]) -> list[int]:
    """A bit for every value that occurs more than once; 0 for nulls and for single ones."""
    count: dict[object, int] = {}
    for v in values:
        count[v] = count.get(v, 0) + 1
    number: dict[object, int] = {}
    return [0 if v is None or count[v] < 2 else 1 << number.setdefault(v, len(number)) for v in values]


def best_fit(sizes: list[int], sources: list[object], clusters: list[object], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item, items in the given order, none larger than the capacity."""
    source_bit = _bits(sources)
    width = max([0, *(b.bit_length() for b in source_bit)])
    marks = [s | c << width for s, c in zip(source_bit, _bits(clusters), strict=True)]
    #: For each residual, the bins that have it by their bitmap; and a bitmap of the residuals in use.
    held: dict[int, dict[int, list[int]]] = {}
    in_use = 0
    bins = 0
    out_bin, out_offset = [], []
    for size, mark in zip(sizes, marks, strict=True):
        ahead = in_use >> size
        residual, own = capacity, None
        while ahead:
            step = (ahead & -ahead).bit_length() - 1
            at = held[size + step]
            own = next((m for m in at if not m & mark), None)
            if own is not None:
                residual = size + step
                break
            ahead &= ahead - 1
        if own is None:
            number, own = bins, 0
            bins += 1
        else:
            at = held[residual]
            number = at[own].pop()
            if not at[own]:
                del at[own]
                if not at:
                    del held[residual]
                    in_use ^= 1 << residual
        left = residual - size
        held.setdefault(left, {}).setdefault(own | mark, []).append(number)
        in_use |= 1 << left
        out_bin.append(number)
        out_offset.append(capacity - residual)
    return out_bin, out_offset


def pack(docs: DataFrame, size: str, key: str = "doc_id", source: str = "source", cluster: str = "cluster", capacity: int = CAPACITY, row: str | None = None) -> DataFrame:
    """One row per document and piece: key, ``piece``, ``size``, ``bin_id``, ``bin_offset``.

    A document larger than the capacity is cut into full pieces, each a bin of its own, and a rest
    that is packed; nothing is dropped. Two items in a bin never share a source or a cluster; null
    sources and clusters conflict with nothing. Empty documents are items of size 0; null or
    negative sizes count as 0. Rows with the same key are separate items. Ties go by key. Bins are
    numbered from the shard, so they are unique but not consecutive. ``row`` names a column of stored
    row numbers, by which rows that are alike are dealt to all shards.
    """
    plain = docs.select(
        F.col(quoted(key)).alias("key"),
        F.greatest(F.coalesce(F.col(quoted(size)), F.lit(0)), F.lit(0)).cast("bigint").alias("size"),
        F.col(quoted(source)).cast("string").alias("source"),
        F.col(quoted(cluster)).cast("string").alias("cluster"),
        (F.lit(0) if row is None else F.col(quoted(row))).cast("bigint").alias("row"),
    )
    total = plain.agg(F.sum("size")).first()[0] or 0
    shards = total // SHARD + 1
    last = F.greatest(F.lit(1), F.ceil(F.col("size") / capacity)) - 1
    pieces = plain.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    pieces = pieces.withColumn("size", F.least(F.col("size") - F.col("piece") * capacity, F.lit(capacity)))
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("key", "piece", "source", "cluster", "row", F.lit("shard")), F.lit(shards)))
    kind = plain.schema["key"].dataType.simpleString()
    schema = f"key {kind}, piece bigint, size bigint, bin_id bigint, bin_offset bigint"

    def one(group: pa.Table) -> pa.Table:
        group = group.sort_by([("size", "descending"), ("key", "ascending"), ("piece", "ascending"), ("source", "ascending"), ("cluster", "ascending")])
        bins, offsets = best_fit(*(group.column(c).to_pylist() for c in ("size", "source", "cluster")), capacity)
        shard = group.column("shard")[0].as_py() if group.num_rows else 0
        return pa.table(
            {
                "key": group.column("key"),
                "piece": group.column("piece"),
                "size": group.column("size"),
                "bin_id": pa.array(np.array(bins, np.int64) + (shard << 32)),
                "bin_offset": pa.array(offsets, pa.int64()),
            }
        )

    packed = pieces.groupBy("shard").applyInArrow(one, schema)
    return packed.withColumnRenamed("key", key)
