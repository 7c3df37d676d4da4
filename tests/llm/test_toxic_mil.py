from __future__ import annotations

import random
import zlib

import numpy as np

from runledger.llm.toxic_mil import (
    SENTENCE, WIDTH, bag_gradient, sentences, toxicity)
from tests.llm.conftest import EDGE

RNG = random.Random(7)
STEMS = ["".join(RNG.choice("abdehilnorstu") for _ in range(RNG.randint(2, 8)))
         for _ in range(1500)]
BAD = ["vilefool", "rotbrain", "grimscum"]


def text(toxic):
    out = [[RNG.choice(STEMS) for _ in range(RNG.randint(3, 12))]
           for _ in range(RNG.randint(1, 12))]
    at = None
    if toxic:
        at = RNG.randrange(len(out))
        out[at].insert(1, RNG.choice(BAD))
    return ". ".join(" ".join(s) for s in out) + ".", at


def remainder(i):
    return zlib.crc32(str(i).encode()) % 3


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(0)
    w = np.zeros(WIDTH + 1)
    w[:20] = rng.normal(size=20) * 0.3
    w[-1] = -1.0
    lens = np.array([2, 3, 0, 1, 4])
    doc = np.array([0, 0, 1, 2, 2])
    idx = rng.integers(0, 20, lens.sum())
    label, weight = np.array([1, 0, 1]), np.array([0.5, 1.0, 2.0])
    grad, _ = bag_gradient(w, label, weight, doc, lens, idx)
    for k in [*range(20), WIDTH]:
        step = np.zeros_like(w)
        step[k] = 1e-5
        up = bag_gradient(w + step, label, weight, doc, lens, idx)[1]
        down = bag_gradient(w - step, label, weight, doc, lens, idx)[1]
        assert abs((up - down) / 2e-5 - grad[k]) < 1e-6


def test_sentences_are_spans_of_the_text():
    t = "Ä b. İx!\nlast? . "
    assert [t[a:b] for a, b, _ in sentences(t)] == ["Ä b.", " İx!", "last?"]
    assert SENTENCE.findall("a.b") == ["a.", "b"]


def test_held_out_accuracy_and_offending_sentences(spark, make_docs):
    made = {i: (i % 5 == 0, *text(i % 5 == 0)) for i in range(900)}
    docs = make_docs([(i, t) for i, (_, t, _) in made.items()] + EDGE[5:6]
                     + [(2000, None), (2001, ""), (2002, made[0][1])])
    labels = spark.createDataFrame(
        [(i, None, int(y)) for i, (y, _, _) in made.items()
         if remainder(i) != 1] + [(2001, 1, None), (None, 1, 1)],
        "doc_id long, quality int, toxic int")
    got = toxicity(docs, labels).collect()
    assert len(got) == 904
    rows = {r.doc_id: r for r in got}
    out = [i for i in made if remainder(i) == 1]
    assert {i for i, r in rows.items() if r.held_out} == set(out) | {
        i for i in (2000, 2001, 2002) if remainder(i) == 1} | {None}
    right = sum(rows[i].predicted == int(made[i][0]) for i in out)
    assert right >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in got)
    assert rows[2000].score == rows[2001].score < 0.5
    for i in out:
        y, t, at = made[i]
        if y and rows[i].predicted:
            spans = [t[s.start:s.end] for s in rows[i].offending]
            assert any(b in s for s in spans for b in BAD)


def test_without_labels_or_rows(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity(make_docs(EDGE), none).collect()
    assert len(got) == len(EDGE) and not any(r.predicted for r in got)
    assert toxicity(make_docs([]), none).count() == 0


def test_words_of_many_toxic_documents_are_learnt_in_a_balanced_sample(
        spark, make_docs):
    """Each bad word stands in a third of the toxic documents, which is a
    sixth of a sample with as many toxic as clean ones."""
    made = {i: (i % 2 == 0, *text(i % 2 == 0)) for i in range(600)}
    docs = make_docs([(i, t) for i, (_, t, _) in made.items()])
    labels = spark.createDataFrame(
        [(i, None, int(y)) for i, (y, _, _) in made.items()],
        "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in toxicity(docs, labels).collect()}
    out = [i for i in made if remainder(i) == 1]
    right = sum(rows[i].predicted == int(made[i][0]) for i in out)
    assert right >= 0.95 * len(out)
