"""Periodic runs of words by the branching-tandem test on an enhanced suffix array.

Documents are taken in batches inside a task; a word is told apart by its document, so suffixes of
different documents share nothing and one suffix array serves the batch. Prefix doubling gives the
array, its inverse and, level by level, the ranks of all substrings whose length is a power of two.
Those ranks then give longest common prefixes and extensions to the left without touching words.

Every LCP interval is a pair of slots and a depth; there are no tree nodes. All suffixes of its
children but the largest one look up the inverse array at ``i + depth`` and ``i - depth``: a partner
in another child of the interval is a square that its next word breaks. Such a square is the right
end of a run; it is rotated to the left as far as the period holds, and squares that end up on the
same stretch are merged to a run with the smallest period. Work is n log n steps of whole arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gristmill.llm.blocks import block_source, spaced, spans, starts_of, texts_of

#: A run has this many words at least, and this many periods.
WORDS = 6
PERIODS = 4
#: Bytes of text that are searched together; a longer document is alone.
BATCH = 1 << 21
_FIELDS = ("start", "length", "period")
_RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in _FIELDS]))


def _levels(words: np.ndarray, nr: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Ranks of the substrings of 1, 2, 4, ... words at every position, until all are different.

    Equal ranks mean equal substrings of the same document that do not reach over its end. The
    last level is the inverse suffix array.
    """
    n = len(words)
    order = np.argsort(nr * (int(words.max()) + 1) + words, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = (words[order[1:]] != words[order[:-1]]) | (nr[order[1:]] != nr[order[:-1]])
    heads = np.flatnonzero(fresh)
    sizes = np.diff(np.append(heads, n))
    rank = np.empty(n, np.int32)
    rank[order] = np.repeat(heads, sizes)
    open_ = order[np.repeat(sizes > 1, sizes)]
    levels, step = [rank], 1
    while len(open_):
        after = open_ + step
        second = np.where(after < end[open_], rank[np.minimum(after, n - 1)].astype(np.int64) + 1, 0)
        first = rank[open_].astype(np.int64)
        by = np.argsort(first * (n + 1) + second, kind="stable")
        open_, first, second = open_[by], first[by], second[by]
        of_group = np.ones(len(open_), bool)
        of_group[1:] = first[1:] != first[:-1]
        part = of_group.copy()
        part[1:] |= second[1:] != second[:-1]
        heads = np.flatnonzero(part)
        sizes = np.diff(np.append(heads, len(open_)))
        # Slots of a group follow each other, so a part starts as far into them as it comes in the group.
        groups = np.flatnonzero(of_group)
        into = np.arange(len(open_)) - np.repeat(groups, np.diff(np.append(groups, len(open_))))
        rank = rank.copy()
        rank[open_] = np.repeat((first + into)[heads], sizes)
        open_ = open_[np.repeat(sizes > 1, sizes)]
        levels.append(rank)
        step *= 2
    return levels


def _prefixes(levels: list[np.ndarray], array: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Longest common prefix of each suffix in the array and the one before it."""
    lcp = np.zeros(len(array), np.int64)
    held = np.flatnonzero(levels[0][array[1:]] == levels[0][array[:-1]]) + 1
    nested = [held]
    for rank in levels[1:]:
        held = held[rank[array[held]] == rank[array[held - 1]]]
        nested.append(held)
    for k in range(len(levels) - 1, -1, -1):
        at = nested[k]
        a, b = array[at - 1] + lcp[at], array[at] + lcp[at]
        inside = (a < end[array[at - 1]]) & (b < end[array[at]])
        at, a, b = at[inside], a[inside], b[inside]
        lcp[at[levels[k][a] == levels[k][b]]] += 1 << k
    return lcp


def _nearest_smaller(values: np.ndarray, at: np.ndarray, way: int) -> np.ndarray:
    """For each position of ``at`` the next one in direction ``way`` with a smaller value.

    All values between a position and what it points to are no smaller than its own, so a pointer
    may jump on by the pointer it has reached, found or not.
    """
    to = np.arange(len(values)) + way
    left = at
    while len(left):
        left = left[values[to[left]] >= values[left]]
        to[left] = to[to[left]]
    return to[at]


def _squares(levels: list[np.ndarray], begin: np.ndarray, end: np.ndarray, periods: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and half length of every square that the next word breaks, where a document can hold ``periods`` of them."""
    inverse = levels[-1]
    array = np.empty(len(inverse), np.int64)
    array[inverse] = np.arange(len(inverse))
    lcp = np.append(_prefixes(levels, array, end), 0)
    cut = np.flatnonzero(lcp)
    low, high = _nearest_smaller(lcp, cut, -1), _nearest_smaller(lcp, cut, 1)
    own = array[cut]
    cut_fits = periods * lcp[cut] <= end[own] - begin[own]
    cut, low, high = cut[cut_fits], low[cut_fits], high[cut_fits]
    if not len(cut):
        return cut, cut
    by = np.argsort(low * (len(lcp) + 1) + high, kind="stable")
    cut, low, high = cut[by], low[by], high[by]
    fresh = np.ones(len(cut), bool)
    fresh[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    heads = np.flatnonzero(fresh)
    of = np.cumsum(fresh) - 1
    # Children: from the interval's first slot to its first cut, then from cut to cut.
    stop = np.append(cut[1:], 0)
    last = np.append(heads[1:], len(cut)) - 1
    stop[last] = high[last]
    size, first_size = stop - cut, cut[heads] - low[heads]
    most = np.maximum(np.maximum.reduceat(size, heads), first_size)
    first_small = first_size < most
    largest = np.flatnonzero((size == most[of]) & first_small[of])
    largest = largest[np.append(True, of[largest][1:] != of[largest][:-1])[: len(largest)]]
    small = np.ones(len(cut), bool)
    small[largest] = False
    child = np.concatenate([cut[small], low[heads][first_small]])
    until = np.concatenate([stop[small], cut[heads][first_small]])
    inside = np.concatenate([of[small], np.flatnonzero(first_small)])
    count = until - child
    each = np.repeat(np.arange(len(child)), count)
    slot = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count) + child[each]
    i, depth = array[slot], lcp[cut[heads]][inside][each]
    child, until = child[each], until[each]
    low, high = low[heads][inside][each], high[heads][inside][each]
    starts, halves = [], []
    for start, partner in ((i, i + depth), (i - depth, i - depth)):
        there = np.flatnonzero((partner >= begin[i]) & (partner < end[i]))
        r = inverse[partner[there]]
        other = (r >= low[there]) & (r < high[there]) & ((r < child[there]) | (r >= until[there]))
        starts.append(start[there[other]])
        halves.append(depth[there[other]])
    return np.concatenate(starts), np.concatenate(halves)


def find_runs(words: np.ndarray, lens: np.ndarray, least: int = WORDS, periods: int = PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (in the row of all words), length and smallest period of every run, by start and period."""
    nothing = np.zeros(0, np.int64)
    if not len(words):
        return nothing, nothing, nothing
    first = starts_of(lens)
    nr = np.repeat(np.arange(len(lens)), lens)
    begin, end = first[:-1][nr], first[1:][nr]
    levels = _levels(words.astype(np.int64), nr, end)
    start, period = _squares(levels, begin, end, periods)
    stop = start + 2 * period
    for k in range(len(levels) - 1, -1, -1):
        back = start - (1 << k)
        fits = np.flatnonzero(back >= begin[start])
        same = levels[k][back[fits]] == levels[k][back[fits] + period[fits]]
        start[fits[same]] = back[fits[same]]
    length = stop - start
    kept = length >= np.maximum(least, periods * period)
    start, length, period = start[kept], length[kept], period[kept]
    # A stretch found with a multiple of its period is the same stretch.
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[fresh], length[fresh], period[fresh]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def periodic_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = WORDS, periods: int = PERIODS) -> DataFrame:
    """Per document row: the key, ``n_words``, ``runs`` and ``collapsed``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch with smallest period
    ``period``, at least ``least`` words and ``periods`` periods (2 or more) long, that no
    neighbouring word extends with that period; ``runs`` holds all of them by start and period.
    ``collapsed`` joins by one space the words that no run contains after its first period.

    Every row is judged by itself: repeated rows and keys give repeated results, a null key stays
    null, a null or empty text has no words, no runs and an empty ``collapsed``. Other columns are
    not read. Nothing is shuffled; a task holds ``BATCH`` bytes of text at a time, or one document
    (about 4 bytes a word for each doubling of its longest repeat).
    """
    if periods < 2:
        raise ValueError("a run has two periods at least")
    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", _RUNS),
            T.StructField("collapsed", T.StringType()),
        ]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, sizes = texts_of(batch)
            for low, high in spans(sizes, BATCH):
                cut = [spaced(t) for t in raw.slice(low, high - low).to_pylist()]
                flat = list(chain.from_iterable(cut))
                vocab = set(flat)
                number = dict(zip(vocab, range(len(vocab)), strict=True))
                ids = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
                lens = np.fromiter(map(len, cut), np.int64, len(cut))
                start, length, period = find_runs(ids, lens, least, periods)
                first = starts_of(lens)
                of = np.searchsorted(first, start, "right") - 1
                gone = np.zeros(len(flat) + 1, np.int64)
                np.add.at(gone, start + period, 1)
                np.add.at(gone, start + length, -1)
                stay = np.cumsum(gone)[:-1] == 0
                left = starts_of(stay)
                texts = []
                for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
                    whole = left[b] - left[a] == b - a
                    texts.append(b" ".join(cut[k] if whole else compress(cut[k], stay[a:b].tolist())))
                found = pa.StructArray.from_arrays([pa.array(x) for x in (start - first[of], length, period)], names=list(_FIELDS))
                bounds = np.searchsorted(of, np.arange(len(lens) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(lens),
                        pa.ListArray.from_arrays(pa.array(bounds), found),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                    ],
                    names=schema.names,
                )

    return block_source(docs, text, (key,)).mapInArrow(search, schema)
