"""Benchmark decontamination over a distributed positional inverted index.

The index is partitioned by documents: a row holds the postings of all words of one block, sorted
by word and position, so a word that is everywhere is spread over all blocks. Phrases come to the
blocks in bounded chunks. In a block each phrase starts from the postings of its rarest term there
and intersects them, shifted by their offsets, with those of the next rarest until all terms are
found. With ``slop`` 0 matches are exact phrases; with more, each term may lie that many words
beside its place.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill import scratch
from gristmill.functions.names import quoted
from gristmill.llm.blocks import alnum_lower, block_schema, block_source, pack_blocks, starts_of, unpack, vocabulary

WINDOW = 10
#: Free positions between the documents of a block, so that no phrase crosses from one to the next.
GAP = 1024
#: Phrases are sent to the tasks in chunks of about so many bytes of text, whatever their number.
CHUNK_BYTES = 16 << 20


def build_index(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The postings of all words of all documents, written once and read back.

    Per block: document keys, ``lens`` (their word counts), the sorted ``vocab``, ``counts`` (the
    postings of each word) and ``positions`` (ascending for each word). Null text has no words;
    repeated keys stay separate documents.
    """
    whole = block_schema(docs, (key,))
    names = ["block", f"k_{key}", "lens", "vocab", "counts", "positions"]
    schema = T.StructType([whole[c] for c in names[:4]] + [T.StructField(c, T.BinaryType()) for c in names[4:]])

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in pack_blocks(batches, alnum_lower, whole.names):
            lens, ids, words = unpack(*(row.column(c)[0].as_py() for c in ("lens", "ids", "vocab")))
            order = np.argsort(ids, kind="stable")
            place = np.arange(len(ids)) + GAP * (1 + np.repeat(np.arange(len(lens)), lens))
            kind = np.uint32 if not len(place) or place[-1] < 1 << 32 else np.int64
            counts = np.bincount(ids, minlength=len(words)).astype(np.uint32)
            packed = [pa.array([x.tobytes()], pa.binary()) for x in (counts, place[order].astype(kind))]
            yield pa.RecordBatch.from_arrays([*(row.column(c) for c in names[:4]), *packed], names=names)

    return scratch.materialize(block_source(docs, text, (key,)).mapInArrow(invert, schema), "postings")


class Phrases:
    """Distinct windows of some items, as a matrix of term numbers, and the items of each."""

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        owners: dict[tuple[bytes, ...], list[object]] = {}
        for key, text in items:
            words = alnum_lower((text or "").encode())
            n = min(window, len(words))
            for i in range(len(words) - n + 1 if n else 0):
                own = owners.setdefault(tuple(words[i : i + n]), [])
                if not own or own[-1] != key:
                    own.append(key)
        self.owners = list(owners.values())
        self.terms = sorted({w for phrase in owners for w in phrase})
        number = {w: i for i, w in enumerate(self.terms)}
        self.lens = np.fromiter(map(len, owners), np.int64, len(owners))
        self.matrix = np.full((len(owners), window), -1, np.int64)
        for row, phrase in enumerate(owners):
            self.matrix[row, : len(phrase)] = [number[w] for w in phrase]

    def find(self, words: list[bytes], counts: np.ndarray, positions: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window numbers, start positions and places of the rarest term of all matches in a block."""
        at = {w: i for i, w in enumerate(words)}
        local = np.fromiter((at.get(w, -1) for w in self.terms), np.int64, len(self.terms))
        size = np.where(local >= 0, counts[local], 0) if len(words) else np.zeros(len(local), np.int64)
        inside = self.matrix >= 0
        held = np.where(inside, size[self.matrix], np.iinfo(np.int64).max)
        alive = np.flatnonzero((held > 0).all(axis=1))
        order = np.argsort(held[alive], axis=1, kind="stable")
        first = starts_of(counts)
        keys = (np.repeat(np.arange(len(words)), counts) << 40) | positions
        # The rarest term's postings, moved to where the phrase would start.
        rarest = local[self.matrix[alive, order[:, 0]]] if len(alive) else alive
        n = counts[rarest].astype(np.int64)
        row = np.repeat(np.arange(len(alive)), n)
        seat = positions[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[rarest], n)]
        start = seat - order[row, 0]
        for k in range(1, self.matrix.shape[1]):
            offset = order[row, k]
            term = self.matrix[alive[row], offset]
            key = (local[term] << 40) | np.maximum(start + offset, 0)
            near = np.minimum(np.searchsorted(keys, key - slop), max(0, len(keys) - 1))
            ok = (term < 0) | (keys[near] <= key + slop) if len(keys) else term < 0
            ok &= (term < 0) | (keys[near] >= key - slop)
            row, start, seat = row[ok], start[ok], seat[ok]
        return alive[row], start, seat


def search(index: DataFrame, items: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Matches of the items' windows: one row per document and item that meet.

    Columns: ``block`` and ``nr`` (the document within it), the document's key, ``item``,
    ``starts`` and ``lengths`` (word offsets and window lengths). Items of fewer words than
    ``window`` are one window; items without words, or with a null id, match nothing. All items
    are searched, chunk by chunk; a chunk is about ``CHUNK_BYTES`` at any number of items.
    """
    if not 0 <= slop < GAP // 2:
        raise ValueError(f"slop must be from 0 to {GAP // 2 - 1}")
    spark = index.sparkSession
    key = next(c for c in index.columns if c.startswith("k_"))
    plain = items.select(F.col(quoted(item)).alias("item"), F.col(quoted(text)).alias("text")).where("item is not null and text is not null")
    total = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = total // CHUNK_BYTES + 1
    kind = plain.schema["item"].dataType
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("nr", T.IntegerType()),
            T.StructField(key[2:], index.schema[key].dataType.elementType),
            T.StructField("item", T.StringType()),
            T.StructField("starts", T.ArrayType(T.LongType())),
            T.StructField("lengths", T.ArrayType(T.IntegerType())),
        ]
    )

    def part(chunk: int) -> DataFrame:
        mine = plain.where(F.pmod(F.xxhash64("item", "text"), F.lit(chunks)) == chunk)
        # Bounded by the chunk: a share of the items of about CHUNK_BYTES.
        phrases = spark.sparkContext.broadcast(Phrases([tuple(r) for r in mine.toLocalIterator()], window))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            wanted = phrases.value
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {c: batch.column(c)[i] for c in batch.schema.names}
                    words = vocabulary(row["vocab"].as_py())
                    counts = np.frombuffer(row["counts"].as_py(), np.uint32)
                    packed = row["positions"].as_py()
                    wide = len(packed) > 4 * counts.sum(dtype=np.int64)
                    positions = np.frombuffer(packed, np.int64 if wide else np.uint32).astype(np.int64)
                    if not len(positions) or not len(wanted.lens):
                        continue
                    window_nr, start, seat = wanted.find(words, counts, positions, slop)
                    lens = np.frombuffer(row["lens"].as_py(), np.int64)
                    base = starts_of(lens)[:-1] + GAP * (1 + np.arange(len(lens)))
                    nr = np.searchsorted(base, seat, side="right") - 1
                    found: dict[tuple[int, object], tuple[list[int], list[int]]] = {}
                    for w, n, s in zip(window_nr.tolist(), nr.tolist(), (start - base[nr]).tolist(), strict=True):
                        for owner in wanted.owners[w]:
                            starts, lengths = found.setdefault((n, owner), ([], []))
                            starts.append(s)
                            lengths.append(int(wanted.lens[w]))
                    if found:
                        keys = row[key].as_py()
                        columns = [
                            [row["block"].as_py()] * len(found),
                            [n for n, _ in found],
                            [keys[n] for n, _ in found],
                            [str(owner) for _, owner in found],
                            [s for s, _ in found.values()],
                            [x for _, x in found.values()],
                        ]
                        types = [pa.int64(), pa.int32(), batch.schema.field(key).type.value_type, pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names
                        )

        return index.mapInArrow(scan, schema).withColumn("item", F.col("item").cast(kind))

    return reduce(DataFrame.unionByName, [part(c) for c in range(chunks)])


def documents(index: DataFrame) -> DataFrame:
    """Every indexed document: ``block``, ``nr``, its key and ``n_words``."""
    key = next(c for c in index.columns if c.startswith("k_"))
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("nr", T.IntegerType()),
            T.StructField(key[2:], index.schema[key].dataType.elementType),
            T.StructField("n_words", T.LongType()),
        ]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lens = np.frombuffer(batch.column("lens")[i].as_py(), np.int64)
                columns = [np.full(len(lens), batch.column("block")[i].as_py()), np.arange(len(lens), dtype=np.int32), batch.column(key)[i].values, lens]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=schema.names)

    return index.select("block", key, "lens").mapInArrow(rows, schema)


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document row: key, ``n_words``, ``n_hit``, ``items`` (sorted, as text) and ``contaminated``.

    A word is hit if an exact occurrence of any window covers it. Documents without words, and an
    empty table of items, give no hits. Every document row is returned.
    """
    index = build_index(docs, text, key)
    matches = search(index, items, item, item_text, window)
    spots = F.expr("flatten(transform(starts, (s, i) -> transform(sequence(0, lengths[i] - 1), o -> s + o)))")
    hits = matches.groupBy("block", "nr").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(F.array_distinct(spots))))).cast("bigint").alias("hit"),
        F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("found"),
    )
    return documents(index).join(hits, ["block", "nr"], "left").select(
        F.col(quoted(key)),
        "n_words",
        F.coalesce("hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("found", F.array().cast("array<string>")).alias("items"),
        F.col("hit").isNotNull().alias("contaminated"),
    )
