"""Words of blocks: how they are split, numbered and hashed."""

import random

import numpy as np
import pyarrow as pa
import pytest

from gristmill.llm.blocks import alnum_lower, joined_hashes, pack_blocks, spaced, spaced_lower, unpack
from gristmill.llm.ladder import _numbered

TEXTS = [b"", b"  ", b"a", b" A b\x0bC\x0c\r\n\td ", b"\xff\xfe Z\x1cz", None, "\u00c9 \u00c4 x y".encode(), b"a  b", b"\n", b"\x00 a\x00b"]


@pytest.mark.parametrize("words", [spaced, spaced_lower, alnum_lower])
@pytest.mark.parametrize("texts", [TEXTS, TEXTS[:2], TEXTS[2:3]])
def test_texts_are_split_as_by_hand(monkeypatch, words, texts):
    monkeypatch.setattr("gristmill.llm.blocks.TaskContext.get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.binary())], names=["k", "text"])
    names = ["block", "k_doc_id", "n_tokens", "lens", "ids", "vocab"]
    row = {c: x[0] for c, x in next(pack_blocks([batch], words, names)).to_pydict().items()}
    lens, ids, vocab = unpack(row["lens"], row["ids"], row["vocab"])
    cut = [words(t or b"") for t in texts]
    flat = [w for c in cut for w in c]
    assert lens.tolist() == list(map(len, cut)) and vocab == sorted(set(flat)) and [vocab[i] for i in ids] == flat
    assert row["n_tokens"] == len(flat)


def test_hashes_of_joined_words():
    rnd = random.Random(1)
    words = sorted({bytes(rnd.choice(b"ab\x00\xff") for _ in range(rnd.choice([1, 2, 7, 8, 9, 16, 17, 63, 64, 65, 200]))) for _ in range(3000)})
    known = dict(zip(words, joined_hashes(b"\n".join(words)).tolist(), strict=True))
    assert len(set(known.values())) == len(words)
    rnd.shuffle(words)
    assert joined_hashes(b"\n".join(words)).tolist() == [known[w] for w in words]
    assert len(joined_hashes(b"")) == 0 and joined_hashes(words[0]).tolist() == [known[words[0]]]


@pytest.mark.parametrize("bits", [3, 12, 40, 62])
@pytest.mark.parametrize("n", [0, 1, 1000])
def test_keys_are_numbered_in_order(bits, n):
    keys = np.random.default_rng(2).integers(0, 1 << bits, n)
    keys = keys[np.arange(n) // 2]
    found, number = _numbered(keys, bits)
    distinct, inverse = np.unique(keys, return_inverse=True)
    assert (found == distinct).all() and (number == inverse).all()
