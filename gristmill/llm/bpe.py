"""Token counts of a BPE vocabulary with byte fallback, by rank-synchronous array merging.

Texts are cut into pre-tokens that no piece crosses. The distinct pre-tokens of a batch lie in
one ragged array of symbols. In each round every sequence finds its lowest-ranked adjacent pair,
and all sequences merge theirs at once. Where no piece can rank before one of its own parts, all
occurrences of the pair in a sequence merge in the same round; elsewhere only the leftmost one
does, which is the order that the vocabulary's own library follows. What survives is counted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.names import quoted
from gristmill.llm.blocks import spans

MARK = "▁"  # stands for a space
LIMIT = 4096
BATCH_BYTES = 4 << 20
CACHED = 300_000
_NONE = np.int64(1) << 40  # ranks after every piece


class Vocabulary:
    """Symbols, merges and costs of a sentencepiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [
            i
            for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        ids.sort(key=lambda i: (-model.get_score(i), i))
        pieces = [model.id_to_piece(i) for i in ids]
        scores = [model.get_score(i) for i in ids]
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("a piece crosses a space, so texts can't be cut at spaces")
        self.number = {p: k for k, p in enumerate(pieces)}
        self.size = len(pieces)
        #: Equal scores are equal ranks; the leftmost pair goes first.
        rank = np.cumsum([0] + [a != b for a, b in zip(scores, scores[1:], strict=False)]).astype(np.int64)
        merges: dict[int, int] = {}
        first = np.full(self.size, _NONE)  # the best rank of a longer piece that starts or ends with this one
        for k, p in enumerate(pieces):
            for cut in range(1, len(p)):
                left, right = self.number.get(p[:cut]), self.number.get(p[cut:])
                if left is not None:
                    first[left] = min(first[left], rank[k])
                if right is not None:
                    first[right] = min(first[right], rank[k])
                if left is not None and right is not None:
                    merges[left << 32 | right] = k
        keys = np.fromiter(merges, np.int64, len(merges))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.merged = np.fromiter(merges.values(), np.int64, len(merges))[order]
        self.rank = rank
        shared = np.bincount(rank)[rank] > 1
        self.together = (first > rank) & ~shared
        inside = {c for p in pieces for c in p}
        #: A character that no piece holds costs its bytes and ends a pre-token.
        self.inside = inside
        apart = "" if "\n" in inside else "\n"
        self.pattern = re.compile(f"{MARK}*[^{MARK}{apart}]+|{MARK}+" + (f"|{apart}" if apart else ""))

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair; a rank of _NONE where there is none."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = (self.keys[at] == key) & (left < self.size) & (right < self.size)
        piece = self.merged[at]
        return np.where(found, self.rank[piece], _NONE), piece

    def counts(self, tokens: list[str]) -> np.ndarray:
        """How many symbols each pre-token has in the end."""
        lens = np.fromiter(map(len, tokens), np.int64, len(tokens))
        whole = "".join(tokens)
        own = {c: self.number.get(c, self.size + len(c.encode("utf-8", "surrogatepass"))) for c in set(whole)}
        symbols = np.fromiter(map(own.__getitem__, whole), np.int64, len(whole))
        of = np.repeat(np.arange(len(tokens)), lens)
        out = np.zeros(len(tokens), np.int64)
        # symbols above the vocabulary's size never merge and cost that many bytes
        cost = lambda s: np.where(s >= self.size, s - self.size, 1)
        while len(symbols):
            same = of[1:] == of[:-1]
            rank, piece = self.pairs(symbols[:-1], symbols[1:])
            rank = np.where(same, rank, _NONE)
            heads = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            best = np.minimum.reduceat(np.append(rank, _NONE), heads)
            busy = best < _NONE
            counts = np.diff(np.append(heads, len(symbols)))
            done = np.repeat(~busy, counts)
            if done.any():
                out += np.bincount(of[done], cost(symbols[done]), minlength=len(out)).astype(np.int64)
            if done.all():
                break
            pick = (rank == np.repeat(best, counts)[:-1]) & ~done[:-1]
            at = np.flatnonzero(pick)
            new = piece[at]
            # The leftmost of each sequence, and others of a pair that may merge together.
            lead = np.concatenate([[True], of[at[1:]] != of[at[:-1]]])
            keep = lead | self.together[new]
            at, new = at[keep], new[keep]
            # Of overlapping pairs (x x x), each second one from the left stays out.
            joint = np.concatenate([[False], at[1:] == at[:-1] + 1])
            run = np.arange(len(at)) - np.maximum.accumulate(np.where(joint, 0, np.arange(len(at))))
            at, new = at[run % 2 == 0], new[run % 2 == 0]
            symbols = symbols.copy()
            symbols[at] = new
            stay = ~done
            stay[at + 1] = False
            symbols, of = symbols[stay], of[stay]
        return out

    def of_texts(self, texts: list[str], known: dict[str, int]) -> list[int]:
        """Token counts of whole texts; ``known`` keeps the counts of frequent pre-tokens."""
        cut = [self.pattern.findall((" " + t).replace(" ", MARK)) if t else [] for t in texts]
        if len(known) > CACHED:
            known.clear()
        new = list({w for ws in cut for w in ws if w not in known})
        known.update(zip(new, self.counts(new).tolist(), strict=True))
        return [sum(map(known.__getitem__, ws)) for ws in cut]


def token_count(text: Column | str, model: str) -> Column:
    """Tokens of a text under the model at path ``model``; null and empty texts have none.

    No begin, end or special tokens are added, special strings are ordinary text, nothing is
    truncated. The result equals the count of the model's own library.
    """

    @F.arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary, known = Vocabulary(model), {}
        for column in batches:
            sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            out: list[int] = []
            for low, high in spans(sizes, BATCH_BYTES):
                texts = [t or "" for t in column.slice(low, high - low).to_pylist()]
                out += vocabulary.of_texts(texts, known)
            yield pa.array(out, pa.int64())

    return count(F.col(quoted(text)) if isinstance(text, str) else text)


def count_tokens(docs: DataFrame, model: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit``; columns of these names are replaced."""
    body = F.col(quoted(text))
    counted = docs.withColumns({"n_bytes": F.coalesce(F.octet_length(body), F.lit(0)).cast("bigint"), "n_tokens": token_count(body, model)})
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
