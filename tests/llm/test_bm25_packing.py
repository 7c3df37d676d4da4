from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from runledger.llm.bm25_packing import (
    IDS, K1, B, VOCABULARY, Encoder, ShardIndex, pack, powers_of_two)
from tests.llm.conftest import EDGE

PATH = public_tokenizers.path(VOCABULARY)
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = Encoder(PATH, cache_entries=40)
RNG = random.Random(9)


def library(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=8), st.sampled_from(
    [" ", "\n", "\t", "  ", " \n", "it's", " word,", "word.", "..", "<|endoftext|>",
     " ", "é", "1,", "x.\ny", "\x1c", "'ll", " 's", "don't."])),
    max_size=9))
def test_ids_equal_library(parts):
    text = "".join(parts)
    assert np.frombuffer(ENCODER.encode(text), "<u2").tolist() == \
        library(text)


def check(rows, pieces, window=1024):
    """Pieces cover every document, sequences are gapless and not padded."""
    docs = defaultdict(list)
    for p in pieces:
        docs[p.doc_id].append(p)
    want = defaultdict(list)
    for d, t in rows:
        want[d].append(library(t) + [0])
    assert set(docs) == set(want)
    for d, all_ids in want.items():
        got = sorted((p.start, p.length, p.ids_crc32, p.doc_tokens)
                     for p in docs[d])
        if len(all_ids) == 1:
            ids, at = all_ids[0], 0
            for start, length, crc, n in got:
                assert start == at and n == len(ids) and length > 0
                part = np.array(ids[at:at + length], "<u4").tobytes()
                assert zlib.crc32(part) == crc
                at += length
            assert at == len(ids)
        else:
            assert sum(g[1] for g in got) == sum(map(len, all_ids))
    seqs = defaultdict(list)
    for p in pieces:
        seqs[p.sequence_id].append((p.offset, p.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window and at & (at - 1) == 0   # no padding at all


def test_every_id_lies_in_one_piece(make_docs):
    words = ["lorem", "ipsum", "dolor", "sit,", "amet.", "x\ny"]
    rows = EDGE + [(100 + k, " ".join(RNG.choice(words) for _ in range(
        RNG.choice([1, 5, 300, 900, 2500])))) for k in range(150)]
    pieces = pack(make_docs(rows), shard=32, task_rows=60).collect()
    check(rows, pieces)


def test_exactly_whole_windows_and_empty_table(make_docs):
    text = " a" * 1023
    assert len(library(text)) == 1023
    check([(1, text)], pack(make_docs([(1, text)])).collect())
    assert pack(make_docs([])).count() == 0


def test_scores_are_bm25():
    rng = np.random.default_rng(4)
    tails = [rng.integers(0, 60, rng.integers(1, 50)) for _ in range(40)]
    idf = rng.random(IDS) + 0.1
    index = ShardIndex(tails, idf, 25.0)
    for i in range(len(tails)):
        want = []
        for t in tails:
            s = 0.0
            for x in set(tails[i].tolist()):
                f = int((t == x).sum())
                s += idf[x] * f * (K1 + 1) / (
                    f + K1 * (1 - B + B * len(t) / 25.0))
            want.append(s)
        assert np.allclose(index.scores(i), want)


def test_neighbours_share_windows(make_docs):
    """Texts of one topic are packed together more often than by chance."""
    vocab = [w[1:] for w in TOKENIZER.get_vocab() if w[0] == "Ġ"
             and w[1:].isascii() and w[1:].islower() and len(w) > 5]
    vocab.sort()
    topics = [vocab[t * 30:t * 30 + 30] for t in range(8)]
    rows = [(k, " ".join(RNG.choice(topics[k % 8]) for _ in range(60)))
            for k in range(240)]
    pieces = pack(make_docs(rows), shard=400, task_rows=1000).collect()
    seqs = defaultdict(set)
    for p in pieces:
        seqs[p.sequence_id].add(p.doc_id)
    same = total = 0
    for ids in seqs.values():
        for a in ids:
            for b in ids:
                if a < b:
                    total += 1
                    same += a % 8 == b % 8
    assert total and same / total > 0.5


def test_tails_are_dealt_by_their_ids(make_docs):
    """Topics interleaved by doc_id meet in shards that hold an eighth of
    the tails, and rows of one null id and text go to several tasks."""
    vocab = sorted(w[1:] for w in TOKENIZER.get_vocab() if w[0] == "Ġ"
                   and w[1:].isascii() and w[1:].islower() and len(w) > 5)
    topics = [vocab[t * 30:t * 30 + 30] for t in range(8)]
    rows = [(k, " ".join(RNG.choice(topics[k % 8]) for _ in range(60)))
            for k in range(640)]
    pieces = pack(make_docs(rows), shard=80, task_rows=10_000).collect()
    check(rows, pieces)
    seqs = defaultdict(set)
    for p in pieces:
        seqs[p.sequence_id].add(p.doc_id)
    pairs = [a % 8 == b % 8 for ids in seqs.values()
             for a in ids for b in ids if a < b]
    assert sum(pairs) > 0.8 * len(pairs)

    same = [(None, "one two three")] * 400
    pieces = pack(make_docs(same), shard=50, task_rows=50).collect()
    check(same, pieces)
    assert len({p.sequence_id >> 35 for p in pieces}) > 4


def test_powers_of_two():
    rest = [(0, 5, 105), (1, 0, 33), (2, 7, 8)]
    out = powers_of_two(rest)
    assert [sum(b - a for _, a, b in s) for s in out] == [128, 4, 2]
