"""Language-model scores by a probabilistic suffix tree over tokens, with spellings at its root.

A context is a run of up to ``WORDS`` tokens of the same document before a token (see ``ladder``
for which are retained). The state of a token is the longest retained suffix of what precedes it;
its distribution is smoothed with those of the shorter ones, down to the root, which has no
context. There a token's count is smoothed with its probability by a tree over its characters,
which stands for as many tokens as there are distinct ones.

Characters: a token stands between boundary marks, and a context is a run of up to ``DEPTH``
characters that reaches back to the token's start. Their contexts are found and kept like those of
tokens, over the distinct tokens weighted by their counts. Whether a token is the end is decided
first, by its share of all tokens.

Texts are read once, into blocks, which are dealt to bucketed files: what is joined to them moves,
they do not. The root's probability of a token is worked out once for each distinct token of a
bucket and sent back to the blocks, together with the token's exact count; grams of several tokens
are added up in the blocks before they are sent. Tables that no later job reads are released.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gristmill import scratch
from gristmill.functions.names import quoted
from gristmill.llm.blocks import expand, id_type, joined, joined_hashes, mix, parted, spaced_lower, starts_of, token_blocks, word_hashes
from gristmill.llm.ladder import HOT, LEAST, climb, loose, squeezed

#: Characters of a context.
DEPTH = 5
#: Tokens of the corpus for each bucket of the vocabulary.
BUCKET = 4_000_000
#: Bytes of text of a block: larger ones have fewer distinct grams a token.
BLOCK = 4 << 20
#: Bytes of text of a file of blocks, and the number of files beyond which they grow.
FILE = 8 << 20
MOST_FILES = 100_000
#: Distinct tokens that are spelled at a time.
SPELLED = 50_000
EDGE = " "  # no token has it
UNIFORM = 1 / 0x110000
#: Tokens of a context.
WORDS = 3
END_SYMBOL = mix(word_hashes([b"\n"]))[0]
TINY = 1e-200
NEVER = 1 << 62


class Tree:
    """Retained contexts with their next-symbol counts, on one machine: what the tables are tested against."""

    def __init__(self, grams: list[tuple[str, int]]):
        self.counts: dict[str, dict[str, int]] = {}
        for gram, n in grams:
            self.counts.setdefault(gram[:-1], {})[gram[-1]] = n
        self.totals = {c: sum(s.values()) for c, s in self.counts.items()}

    def state(self, context: str) -> str:
        """The longest retained suffix."""
        while context and context not in self.counts:
            context = context[1:]
        return context

    def probability(self, context: str, symbol: str) -> float:
        """Smoothed probability of a symbol after a context."""
        context = self.state(context)
        own = self.counts.get(context, {})
        weight = max(1, len(own))
        rest = self.probability(context[1:], symbol) if context else UNIFORM
        return (own.get(symbol, 0) + weight * rest) / (self.totals.get(context, 0) + weight)


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Token counts, token numbers and vocabulary of a block, the words still joined."""
    vocab = expand(row["vocab"])
    words = vocab.count(b"\n") + 1 if vocab else 0
    return np.frombuffer(row["lens"], np.int64), np.frombuffer(expand(row["ids"]), id_type(words)), vocab


def _distinct(group: pa.Table) -> pa.Table:
    """The distinct words of a bucket with their training counts, ``SPELLED`` to a row."""
    coded = parted(group.column("words"))[0].dictionary_encode()
    counts = np.frombuffer(b"".join(group.column("counts").to_pylist()), np.int64)
    n = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(n, coded.indices.to_numpy(zero_copy_only=False), counts)
    bucket = group.column("bucket")[0].as_py() if group.num_rows else 0
    starts = np.arange(0, len(n), SPELLED)
    cut = [n[i : i + SPELLED] for i in starts.tolist()]
    return pa.table(
        {
            "unit": pa.array([bucket << 20 | i for i in range(len(cut))], pa.int64()),
            "bucket": pa.array([bucket] * len(cut), pa.int64()),
            "words": joined(coded.dictionary, np.append(starts, len(n))),
            "counts": pa.array([x.tobytes() for x in cut], pa.binary()),
            "known": pa.array([int(x.sum()) for x in cut], pa.int64()),
            "held": pa.array([int((x > 0).sum()) for x in cut], pa.int64()),
        }
    )


def _spelled(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The characters of all words between boundary marks, where words start, their lengths and counts."""
    text = EDGE + row["words"].decode("utf-8", "replace").replace("\n", EDGE + EDGE) + EDGE
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    marks = np.flatnonzero(codes == ord(EDGE))
    return codes, marks[::2], marks[1::2] - marks[::2] + 1, np.frombuffer(row["counts"], np.int64)


def _characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training counts of characters; the mark before a word does not count."""
    for batch in batches:
        for i in range(batch.num_rows):
            codes, starts, lens, counts = _spelled({c: batch.column(c)[i].as_py() for c in ("words", "counts")})
            weight = np.repeat(counts, lens)
            weight[starts] = 0
            found, at = np.unique(codes, return_inverse=True)
            n = np.bincount(at, weight, len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(n)], names=["code", "n"])


def spellings(words: DataFrame, least: int, whole: Callable[[np.ndarray, np.ndarray], np.ndarray], dealt: int | None = None, used: list[str] | None = None) -> DataFrame:
    """``bucket``, ``words``, ``counts``, ``values`` for rows of ``_distinct``; ``whole`` makes the value
    of a word from its count and the log10 of its spelling. ``dealt`` and ``used`` as for ``climb``."""
    # Bounded by Unicode.
    alphabet = words.select("words", "counts").mapInArrow(_characters, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).where("n > 0")
    rows = sorted(tuple(r) for r in alphabet.toLocalIterator())
    code, seen = np.array([r[0] for r in rows] or [0], np.int64), np.array([r[1] for r in rows] or [0], np.int64)
    total, kinds = int(seen.sum()), max(1, len(rows))
    size = words.agg(F.sum(F.octet_length("words"))).first()[0] or 0

    def read(row: dict, scored: bool) -> tuple:
        codes, starts, lens, counts = _spelled(row)
        coded = pa.array(codes).dictionary_encode()
        found = coded.dictionary.to_numpy()
        at = np.minimum(np.searchsorted(code, found), len(code) - 1)
        n = np.where(code[at] == found, seen[at], 0)
        room = np.arange(len(codes)) - np.repeat(starts, lens)
        hashes = mix(found.astype(np.uint64) + np.uint64(1))
        return coded.indices.to_numpy(), room, np.repeat(counts, lens), hashes, n, (n + kinds * UNIFORM) / (total + kinds) if scored else None

    def finish(row: dict, p: np.ndarray) -> pa.RecordBatch:
        _, starts, _, counts = _spelled(row)
        logs = np.log10(p)
        logs[starts] = 0
        values = whole(counts, np.add.reduceat(logs, starts))
        columns = [pa.array([row["bucket"]], pa.int64()), *(pa.array([x], pa.binary()) for x in (row["words"], row["counts"], values.tobytes()))]
        return pa.RecordBatch.from_arrays(columns, names=["bucket", "words", "counts", "values"])

    units = words.select("unit", "bucket", "words", "counts")
    # A context has one entry at most for each row and next character, so none needs to be split.
    return climb(units, read, DEPTH, total, size, finish, "bucket long, words binary, counts binary, values binary", least, NEVER, dealt=dealt, used=used)


def scores(docs: DataFrame, train: Column, text: str = "text", key: str = "doc_id", least: int = LEAST, hot: int = HOT, depth: int = WORDS) -> DataFrame:
    """Per document row: key, ``train``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Tokens are the lower-cased words and one end. ``train`` says which rows are learned from (null:
    not). ``n_known`` counts tokens seen in training, ``base_score`` is the log10 probability under
    single-token counts with 0.1 added, ``score`` that of each token after its longest retained
    context of up to ``depth`` tokens of the same document. A context was seen ``least`` times in
    training at least; ``hot`` is where its counts are split. Null and empty texts have only the end. Without training rows spellings are uniform, and every second token is the end.
    """
    spark = docs.sparkSession
    marked = docs.select(F.col(quoted(key)).alias("key"), F.coalesce(train, F.lit(False)).alias("train"), F.col(quoted(text)).alias("text"))
    size = marked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = min(MOST_FILES, size // FILE + 1)
    packed = token_blocks(marked, spaced_lower, "text", ("key", "train"), most=BLOCK).withColumnRenamed("block", "unit")
    blocks = scratch.bucketed(packed, "tokens", "unit", dealt)
    tokens, ends = blocks.agg(F.sum("n_tokens"), F.sum(F.size(F.filter("k_train", lambda t: t)))).first()
    tokens, ends = tokens or 0, ends or 0
    buckets = tokens // BUCKET + 1

    def dealt_by(hashes: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """The words of a block by bucket, and where each bucket starts."""
        of = (hashes % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
        return np.argsort(of, kind="stable"), starts_of(np.bincount(of, minlength=buckets)).tolist()

    def vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                lens, ids, vocab = _unpacked(row)
                if not vocab:
                    continue
                words = parted(pa.chunked_array([[vocab]], pa.binary()))[0]
                learned = np.repeat(np.array(row["k_train"], bool), lens)
                counts = np.bincount(ids[learned], minlength=len(words)).astype(np.int64)
                order, cut = dealt_by(joined_hashes(vocab))
                words, counts = words.take(pa.array(order)), counts[order]
                held = [b for b in range(buckets) if cut[b + 1] > cut[b]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(held, pa.int64()),
                        pa.array([row["unit"]] * len(held), pa.int64()),
                        joined(words, np.array([*map(cut.__getitem__, held), len(words)])),
                        pa.array([counts[cut[b] : cut[b + 1]].tobytes() for b in held], pa.binary()),
                    ],
                    names=["bucket", "unit", "words", "counts"],
                )

    used = [scratch.folder(spark, label) for label in ("vocabulary", "spellings", "distinct")]
    packed = blocks.select("unit", "k_train", "lens", "ids", "vocab")
    entries = scratch.materialize(packed.mapInArrow(vocabulary, "bucket long, unit long, words binary, counts binary"), "vocabulary", used[0])
    distinct_words = entries.groupBy("bucket").applyInArrow(_distinct, "unit long, bucket long, words binary, counts binary, known long, held long")
    words = scratch.bucketed(distinct_words, "distinct", "unit", dealt, used[2])
    known, distinct = words.agg(F.coalesce(F.sum("known"), F.lit(0)), F.coalesce(F.sum("held"), F.lit(0))).first()
    total, distinct = known + ends, distinct + (ends > 0)
    weight, is_end = max(1, distinct), (ends + 0.5) / (total + 1)

    def smoothed(counts: np.ndarray, logs: np.ndarray) -> np.ndarray:
        logs = logs + math.log10(1 - is_end)
        with np.errstate(divide="ignore"):
            seen = np.log10((counts + weight * 10**logs) / (total + weight))
        return np.where(counts > 0, seen, math.log10(weight / (total + weight)) + logs)

    valued = scratch.materialize(spellings(words, least, smoothed, dealt, used), "spellings", used[1])

    def judge(asked: pa.Table, known: pa.Table) -> pa.Table:
        n = np.frombuffer(b"".join(known.column("counts").to_pylist()), np.int64)
        v = np.frombuffer(b"".join(known.column("values").to_pylist()), np.float64)
        words, lens = parted(asked.column("words"))
        numbers = pc.index_in(words, parted(known.column("words"))[0]).to_numpy(zero_copy_only=False)
        cut = starts_of(lens).tolist()
        at = [numbers[i:j] for i, j in zip(cut, cut[1:], strict=False)]
        return pa.table(
            {
                "unit": asked.column("unit"),
                "bucket": asked.column("bucket"),
                "n": pa.array([squeezed(n[x]) for x in at], pa.binary()),
                "k": pa.array([squeezed(v[x].astype(np.float32)) for x in at], pa.binary()),
            }
        )

    both = entries.select("bucket", "unit", "words").groupBy("bucket").cogroup(valued.groupBy("bucket"))
    judged = scratch.bucketed(both.applyInArrow(judge, "unit long, bucket long, n binary, k binary"), "roots", "unit", dealt)
    scratch.release(spark, *used)
    end_score = math.log10((ends + weight * is_end) / (total + weight))

    def read(row: dict, scored: bool) -> tuple:
        """An end stands after each document; its number is that after all words."""
        lens, ids, vocab = _unpacked(row)
        h = joined_hashes(vocab)
        counts, values = np.full(len(h) + 1, ends), np.full(len(h) + 1, end_score) if scored else None
        order, cut = dealt_by(h)
        for b in row["back"]:
            if b["level"] == 0:
                at = order[cut[b["bucket"]] : cut[b["bucket"] + 1]]
                counts[at] = loose(b["n"], np.int64)
                if scored:
                    values[at] = loose(b["k"], np.float32)
        lens = lens + 1
        starts = starts_of(lens)
        is_word = np.ones(starts[-1], bool)
        is_word[starts[1:] - 1] = False
        numbers = np.full(len(is_word), len(h), np.int32)
        numbers[is_word] = ids
        room = np.arange(len(numbers)) - np.repeat(starts[:-1], lens)
        weight = np.repeat(np.array(row["k_train"], bool), lens)
        row["spread"] = starts[:-1], lens, numbers, counts, values
        return numbers, room, weight, np.append(mix(h), END_SYMBOL), counts, np.maximum(10**values, TINY) if scored else None

    def finish(row: dict, p: np.ndarray) -> pa.RecordBatch:
        starts, lens, numbers, n, root = row.pop("spread")
        # What was never seen has only weights of contexts, which multiply, so tiny ones are scaled.
        logs = np.log10(p) + np.minimum(root - math.log10(TINY), 0)[numbers]
        base = (np.log10(n + 0.1) - math.log10(total + 0.1 * (distinct + 1)))[numbers]
        sums = [np.add.reduceat(x, starts) if len(starts) else x for x in ((n > 0).astype(np.int64)[numbers], base, logs)]
        keys = pa.array(row["k_key"], pa_kind)
        return pa.RecordBatch.from_arrays([keys, pa.array(row["k_train"], pa.bool_()), pa.array(lens), *map(pa.array, sums)], names=out_names)

    kind, pa_kind = docs.schema[key].dataType.simpleString(), to_arrow_type(docs.schema[key].dataType)
    out_names = ["key", "train", "n_tokens", "n_known", "base_score", "score"]
    schema = f"key {kind}, train boolean, n_tokens long, n_known long, base_score double, score double"
    units = blocks.select("unit", "k_key", "k_train", "lens", "ids", "vocab")
    out = climb(units, read, depth, total, tokens, finish, schema, least, hot, root=judged, dealt=dealt)
    return out.withColumn("train_tokens", F.lit(total).cast("bigint")).withColumnRenamed("key", key)
