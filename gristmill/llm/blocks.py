"""Documents cut into blocks of numbered tokens.

A block is one row that holds some whole documents: their ids, their token counts, the token
numbers of all of them in a row, and the block's own sorted vocabulary. Words are strings only
inside the vocabulary, so everything downstream is arithmetic on integer arrays. A block grows
to ``BLOCK_BYTES`` of text or one document, whichever is more; its size does not depend on the
input. No text is cut: a longer document is a block of its own. Blocks are small enough for most
token numbers to fit two bytes, and compressed, since some operators shuffle them twice.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions.names import quoted

BLOCK_BYTES = 1 << 20
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_ALNUM = bytes(
    LOWER[i] if 0x30 <= i <= 0x39 or 0x41 <= i <= 0x5A or 0x61 <= i <= 0x7A or i >= 0x80 else 0x20
    for i in range(256)
)


def spaced(text: bytes) -> list[bytes]:
    """Words of ``[^\\x20\\x09-\\x0D]+``: bytes split at ASCII white space only."""
    return text.split()


def spaced_lower(text: bytes) -> list[bytes]:
    """The same words with A-Z lower-cased."""
    return text.translate(LOWER).split()


def alnum_lower(text: bytes) -> list[bytes]:
    """Words of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased."""
    return text.translate(_ALNUM).split()


def spans(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows whose sizes sum to ``most`` at most, or single rows."""
    low, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > low and total + size > most:
            yield low, i
            low, total = i, 0
        total += size
    if low < len(sizes):
        yield low, len(sizes)


def texts_of(batch: pa.RecordBatch, column: int = -1) -> tuple[pa.Array, np.ndarray]:
    """A text column as UTF-8 bytes without nulls, and the sizes."""
    raw = pc.fill_null(batch.column(column).cast(pa.binary()), b"")
    return raw, pc.binary_length(raw).to_numpy(zero_copy_only=False)


def block_schema(docs: DataFrame, keep: tuple[str, ...], gaps: bool = False) -> T.StructType:
    """The columns of a block row: ``block``, ``k_`` arrays of kept columns, ``n_tokens``, packed tokens."""
    fields = [T.StructField(f"k_{c}", T.ArrayType(docs.schema[c].dataType)) for c in keep]
    packed = [T.StructField(c, T.BinaryType()) for c in ("lens", "ids", "vocab", *["gaps"] * gaps)]
    return T.StructType([T.StructField("block", T.LongType()), *fields, T.StructField("n_tokens", T.LongType()), *packed])


def joined(words: pa.Array, starts: np.ndarray) -> pa.Array:
    """The words from each start to the next, joined by line feeds."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), words), b"\n")


def parted(rows: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The words that each row joins, all in a row, and their number in each."""
    cut = pc.split_pattern(rows.combine_chunks().view(pa.string()), "\n")
    return cut.flatten().view(pa.binary()), pc.list_value_length(cut).to_numpy(zero_copy_only=False)


def _numbered(raw: pa.Array, words) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Word counts of texts, the numbers of their words, and the distinct ones in byte order, joined."""
    if words in (spaced, spaced_lower):  # the same words, without a Python value for each
        text = raw.view(pa.string())
        cut = pc.ascii_split_whitespace(pc.ascii_lower(text) if words is spaced_lower else text)
        lens = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = cut.flatten().view(pa.binary())
        empty = np.flatnonzero(pc.equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False))
        if len(empty):  # at the ends of texts
            lens -= np.bincount(np.searchsorted(np.cumsum(lens), empty, "right"), minlength=len(lens))
            flat = flat.filter(pc.not_equal(pc.binary_length(flat), 0))
    else:
        each = [words(t) for t in raw.to_pylist()]
        lens = np.fromiter(map(len, each), np.int64, len(each))
        flat = pa.array(list(chain.from_iterable(each)), pa.binary())
    coded = flat.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), id_type(len(order)))
    rank[order.to_numpy(zero_copy_only=False)] = np.arange(len(order))
    vocab = joined(coded.dictionary.take(order), np.array([0, len(order)]))
    return lens, rank[coded.indices.to_numpy(zero_copy_only=False)], vocab[0].as_py()


def pack_blocks(batches: Iterator[pa.RecordBatch], words, names: list[str], gaps: bool = False, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of kept columns and a text, packed to block rows, inside a task."""
    block = TaskContext.get().partitionId() << 33
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        raw, sizes = texts_of(batch)
        for low, high in spans(sizes, most):
            texts = raw.slice(low, high - low)
            lens, ids, vocab = _numbered(texts, words)
            kept = [
                pa.ListArray.from_arrays(pa.array([0, high - low], pa.int32()), column.slice(low, high - low))
                for column in batch.columns[:-1]
            ]
            parts = [lens.tobytes(), ids.tobytes(), vocab]
            if gaps:
                parts.append(b"\0".join(b"\1".join(_WORD.split(t)) for t in texts.to_pylist()))
            parts[1:] = [squeeze.compress(x) for x in parts[1:]]
            packed = [pa.array([x], pa.binary()) for x in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), *kept, pa.array([len(ids)], pa.int64()), *packed], names=names
            )
            block += 1


def block_source(docs: DataFrame, text: str, keep: tuple[str, ...]) -> DataFrame:
    """What ``pack_blocks`` reads: the kept columns and the text, whatever their names."""
    return docs.select(*[F.col(quoted(c)).alias(f"k{i}") for i, c in enumerate(keep)], F.col(quoted(text)).alias("text"))


def token_blocks(docs: DataFrame, words=spaced, text: str = "text", keep: tuple[str, ...] = ("doc_id",), gaps: bool = False, most: int = BLOCK_BYTES) -> DataFrame:
    """One row per block: ``block``, an array for each column in ``keep``, and packed tokens.

    ``lens`` has the int64 token count of each document, ``ids`` the token numbers (two bytes each
    where the vocabulary has 65,536 words at most, else four), ``vocab`` the words in byte order
    joined by line feeds; all but the counts are compressed, as blocks are shuffled whole. Null text counts as empty. Column names in ``docs`` cannot clash, as only
    the named ones are read. ``block`` is unique within a run; write the result before it is used
    twice. With ``gaps``, the white space around the words is kept too (see ``gaps_of``), so that
    whole texts can be put together again. ``most`` is the text of a block in bytes.
    """
    schema = block_schema(docs, keep, gaps)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from pack_blocks(batches, words, schema.names, gaps, most)

    return block_source(docs, text, keep).mapInArrow(build, schema)


def expand(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed) if packed else b""


def vocabulary(packed: bytes) -> list[bytes]:
    """The words of a block."""
    joined = expand(packed)
    return joined.split(b"\n") if joined else []


def gaps_of(packed: bytes) -> list[list[bytes]]:
    """For each document the white space before, between and after its words."""
    return [g.split(b"\1") for g in expand(packed).split(b"\0")]


def id_type(words: int):
    return np.uint16 if words <= 1 << 16 else np.uint32


def unpack(lens: bytes, ids: bytes, vocab: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Token counts, token numbers and vocabulary of a block."""
    words = vocabulary(vocab)
    return np.frombuffer(lens, np.int64), np.frombuffer(expand(ids), id_type(len(words))), words


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word, the same in every task."""
    if not seed:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words, repeat(seed)), np.uint64, len(words))


#: Bytes of a word that are hashed without a Python value.
SHORT = 64
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    h = (h ^ (h >> np.uint64(31))) * _M2
    return h ^ (h >> np.uint64(29))


def joined_hashes(words: bytes) -> np.ndarray:
    """A 64-bit hash of each of the words joined by line feeds, the same in every task; none if there are no bytes."""
    if not words:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(words + bytes(8), np.uint8)
    marks = np.append(np.flatnonzero(raw == 10), len(words))
    starts = np.append(0, marks[:-1] + 1)
    lens = marks - starts
    eights = np.ndarray(len(words) + 1, "<u8", raw, strides=(1,))
    out = mix(lens.astype(np.uint64) + _M1)
    at = np.flatnonzero((lens > 0) & (lens <= SHORT))
    for done in range(0, SHORT, 8):
        left = lens[at] - done
        held = eights[starts[at] + done]
        held &= ~np.uint64(0) >> (np.uint64(8) * (8 - np.minimum(left, 8)).astype(np.uint64))
        out[at] = mix(out[at] * _M1 + held)
        at = at[left > 8]
    for i in np.flatnonzero(lens > SHORT).tolist():
        out[i] = xxhash.xxh3_64_intdigest(words[starts[i] : marks[i]])
    return mix(out)


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` consecutive word hashes."""
    out = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for k in range(n):
        out = mix(out * _M1 + h[k : k + len(out)])
    return out


def starts_of(lens: np.ndarray) -> np.ndarray:
    """Where each document starts in the row of all tokens, and the end of the last one."""
    return np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)
