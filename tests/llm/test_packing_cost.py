"""op7: how often the tokenizer's library is called, and scores of shards
with more ids than the matrix of the index has rows."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa

from runledger.llm import bm25_packing as bp

PATH = public_tokenizers.path(bp.VOCABULARY)
RNG = random.Random(5)


class Counted:
    """A tokenizer that counts its calls."""

    def __init__(self, tokenizer):
        self.tokenizer, self.calls = tokenizer, 0

    def __getattr__(self, name):
        self.calls += name in ("encode", "encode_batch_fast", "model")
        return getattr(self.tokenizer, name)


def words(n):
    return ["".join(RNG.choice("abcdeéñ一0.,'") for _ in range(9)) + str(k)
            for k in range(n)]


def test_new_pieces_go_to_the_library_together():
    encoder = bp.Encoder(PATH)
    encoder.tokenizer = library = Counted(encoder.tokenizer)
    some = words(3000)
    texts = ["\n".join(" ".join(some[k + j:k + j + 5]) for j in (0, 5))
             for k in range(0, 3000, 10)]
    texts[7] = None
    texts = ["" if t is None else t for t in texts]
    got = [ids.tolist() for ids in encoder.encode_all(pa.array(texts))]
    assert library.calls <= 3000 // bp.JOINED + 1
    calls = library.calls
    assert [ids.tolist() for ids in encoder.encode_all(
        pa.array(texts))] == got
    assert library.calls == calls
    assert got == [library.tokenizer.encode(
        t, add_special_tokens=False).ids for t in texts]


def test_slices_and_small_tables(monkeypatch):
    monkeypatch.setattr(bp, "SLICE_BYTES", 200)
    encoder = bp.Encoder(PATH, cache_entries=30)
    some = words(60) + ["a" * 300, "x\ty", "\xa0", "<|endoftext|>", "", "\n",
                        "z\x85"]
    texts = [" ".join(RNG.choice(some) for _ in range(RNG.randrange(12)))
             for _ in range(200)]
    column = pa.array(["left out", *texts]).slice(1)
    got = [ids.tolist() for ids in encoder.encode_all(column)]
    assert got == [encoder.tokenizer.encode(
        t, add_special_tokens=False).ids for t in texts]
    assert len(encoder.units) <= 30
    assert list(encoder.encode_all(column.slice(0, 0))) == []


def test_scores_beyond_the_matrix():
    rng = np.random.default_rng(2)
    ids = rng.permutation(bp.IDS)[:4 * bp.COMMON]
    tails = [rng.choice(ids[:1 + k * 30], 40) for k in range(60)]
    tails += tails[:20]
    idf = rng.random(bp.IDS) + 0.1
    index = bp.ShardIndex(tails, idf, 30.0)
    assert len(index.doc)                        # ids outside the matrix
    weight = np.zeros((len(tails), bp.IDS))
    for k, t in enumerate(tails):
        x, f = np.unique(t, return_counts=True)
        weight[k, x] = idf[x] * f * (bp.K1 + 1) / (
            f + bp.K1 * (1 - bp.B + bp.B * len(t) / 30.0))
    for i in (0, 5, 3, 79, 40):
        got = index.scores(i, np.arange(i + 1, len(tails)))
        assert np.allclose(got, weight[:, np.unique(tails[i])].sum(1))
    assert len(index.ahead) > 1                  # others came along
