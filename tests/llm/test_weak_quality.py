from __future__ import annotations

import random

import numpy as np

from runledger.llm.weak_quality import (
    estimate, features, quality, reject_junk, variety, votes)
from runledger.llm.weak_quality import statistics as stats
from tests.llm.conftest import EDGE

RNG = random.Random(11)
STEMS = ["".join(RNG.choice("aeioubcdlmnrst") for _ in range(RNG.randint(3, 9)))
         for _ in range(900)]


def prose(n):
    out = []
    for k in range(n):
        out.append(RNG.choice(["the", "of", "and", "to", "in"])
                   if k % 4 == 0 else RNG.choice(STEMS))
        if k % 12 == 11:
            out[-1] += "."
    return " ".join(out)


def junk(kind):
    w = prose(60).split()
    if kind == 0:
        return " ".join(x + "$$$" for x in w)
    if kind == 1:
        return " | ".join(x for x in w if len(x) > 3)
    if kind == 2:
        return " ".join(w[k // 8] for k in range(200))
    return " ".join(x.upper() + "!!" for x in w)


def test_held_out_documents_are_told_apart(make_docs):
    good = [(k, prose(RNG.randint(3, 300))) for k in range(300)]
    bad = [(1000 + k, junk(k % 4)) for k in range(60)]
    got = {r.doc_id: r for r in quality(make_docs(good + bad)).collect()}
    kept_good = sum(got[i].kept for i, _ in good) / len(good)
    kept_bad = sum(got[i].kept for i, _ in bad) / len(bad)
    assert kept_good >= 0.99 and kept_bad <= 0.05
    assert all(0 <= r.score <= 1 for r in got.values())


def test_em_recovers_accuracies():
    """Simulated votes of known rates, abstentions at random."""
    rng = np.random.default_rng(2)
    y = rng.random(40000) < 0.8
    junk_rate = np.where(y[:, None], [0.01, 0.01, 0.005, 0.005, 0.02],
                         [0.9, 0.7, 0.8, 0.6, 0.7])
    v = np.where(rng.random(junk_rate.shape) < junk_rate, -1, 1)
    v[rng.random(v.shape) < 0.2] = 0
    pats, of, n = np.unique(v, axis=0, return_inverse=True,
                            return_counts=True)
    post, rates = estimate(pats, n.astype(float), 200)
    assert np.allclose(rates[1], 0.01, atol=0.01)
    assert np.allclose(rates[0], [0.9, 0.7, 0.8, 0.6, 0.7], atol=0.05)
    assert np.mean((post[of.ravel()] > 0.5) == y) >= 0.98


def test_edges(make_docs):
    docs = make_docs(EDGE)
    assert quality(docs).count() == len(EDGE)
    out = reject_junk(docs)
    assert out.columns == docs.columns
    assert quality(make_docs([])).count() == 0
    assert votes(stats("")[1])[0] == -1


def test_variety_is_that_of_equal_stretches():
    words = prose(397).split()
    assert variety(words) == len(set(words)) / len(words)
    assert abs(variety(words * 40) - variety(words)) < 0.05
    assert variety([]) == 0.0 and variety(["a"] * 4001) < 0.01


def test_long_words_keep_their_whole_shape():
    cache = {}
    one, other = ("a1" * 5000 + end for end in "-+")
    assert features(one, cache)[1] != features(other, cache)[1]
    assert not cache
