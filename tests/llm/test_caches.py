"""Caches of the workers hold no long words, so their bytes are bounded."""

from __future__ import annotations

import hashlib
import os
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

from runledger.llm import (
    bm25_packing, count_tree, spaced_seeds, toxic_mil, weak_quality)
from runledger.llm.common import CACHED_LENGTH

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(
    os.path.abspath(__file__))))
LONG = [hashlib.sha512(str(i).encode()).hexdigest() * 40 for i in range(50)]


def small(cache):
    return all(len(w) <= CACHED_LENGTH for w in cache)


def test_hashes_of_long_words():
    text = " ".join(LONG + ["short", "words"])
    first = spaced_seeds.word_hashes(text)
    assert first == spaced_seeds.word_hashes(text)
    assert len(set(first)) == 52 and small(spaced_seeds._CACHE)
    assert "short" in spaced_seeds._CACHE
    sets = count_tree.shingles(text, 4)
    assert np.array_equal(sets, count_tree.shingles(text, 4))
    assert len(sets) == 49 and small(count_tree._WORDS)


def test_pieces_of_long_words():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    encoder = bm25_packing.Encoder(
        public_tokenizers.path(bm25_packing.VOCABULARY))
    for word in LONG[:5] + ["word" * 400, "short"]:
        for text in (word, word + ",", word + "."):
            for blank, cache in (("", encoder.first), (" ", encoder.spaced)):
                want = encoder.whole(blank + text)
                assert encoder._piece(text, blank, cache) == want
    assert small(encoder.first) and small(encoder.spaced)


def test_features_and_scores_of_long_words(spark):
    docs = spark.createDataFrame(
        [(i, f"{w} bad. good day") for i, w in enumerate(LONG)],
        "doc_id long, text string")
    w = np.zeros(toxic_mil.WIDTH + 1)
    w[-1] = -3.0
    for i in toxic_mil.word_features("bad"):
        w[i] += 2.0
    got = toxic_mil.score(docs, w).collect()
    assert len(got) == len(LONG) and all(
        len(r.offending) == 1 and r.offending[0].start == 0 for r in got)


def test_only_the_operator_at_work_keeps_a_cache():
    pytest.importorskip("public_tokenizers")
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0]), pa.array([7]), pa.array(["one two"])],
        ["row_no", "doc_id", "text"])
    steps = [
        (weak_quality._SHAPES, lambda: weak_quality._featurized(batch)),
        (count_tree._WORDS, lambda: count_tree.shingles("one two", 2)),
        (spaced_seeds._CACHE, lambda: spaced_seeds.word_hashes("one two")),
        (bm25_packing._ENCODERS,
         lambda: bm25_packing._encoder(bm25_packing.VOCABULARY))]
    for cache, step in steps + steps[:1]:
        step()
        assert [c for c, _ in steps if c] == [cache]


def test_features_are_made_for_a_slice_of_a_batch_at_a_time(spark):
    n = 2 * weak_quality.SLICE_ROWS + 3
    docs = spark.createDataFrame(
        [(i, f"The cat no. {i} sat on the mat.") for i in range(n)],
        "doc_id long, text string").coalesce(1)
    rows = weak_quality.featurize(docs).collect()
    assert sorted(r.doc_id for r in rows) == list(range(n))
    for r in rows:
        votes, idx, val = weak_quality.features(
            f"The cat no. {r.doc_id} sat on the mat.")
        assert (r.votes, r.idx) == (votes, idx) and np.allclose(r.val, val)


def test_a_shape_is_held_once():
    shapes = {}
    weak_quality.features("Alpha Bravo 12 345", shapes)
    assert shapes["Alpha"] is shapes["Bravo"]
    assert shapes["12"] is shapes["345"]


# MB that an encoder holds after some texts, beyond those before them.
HELD = """
import random, re, sys
import pyarrow as pa
from runledger.llm import bm25_packing as bp

def mb():
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"Pss_Anon: +([0-9]+)", f.read())[1]) / 1024

encoder = bp._encoder(bp.VOCABULARY)
rng = random.Random(3)
words = ["%x" % rng.getrandbits(28) for _ in range(3000)]
texts = pa.array([" ".join(rng.choices(words, k=2000)) for _ in range(1500)])
pa.default_memory_pool().release_unused()
before, n = mb(), 0
for ids in encoder.encode_all(texts):
    n += 1
assert n == len(texts)
del ids
print(mb() - before)
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"),
                    reason="memory can't be read here")
def test_an_encoder_gives_back_what_a_slice_took():
    pytest.importorskip("public_tokenizers")
    got = subprocess.run([sys.executable, "-c", HELD], cwd=ROOT, text=True,
                         capture_output=True, check=True)
    assert float(got.stdout) < 25
