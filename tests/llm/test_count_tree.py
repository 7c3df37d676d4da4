from __future__ import annotations

import random

import pytest

from runledger.llm import count_tree
from runledger.llm.count_tree import (
    deduplicate, near_duplicates, shingles, similar_pairs)
from tests.llm.conftest import EDGE

RNG = random.Random(1)
VOCAB = ["".join(RNG.choice("abcdefg") for _ in range(RNG.randint(1, 5)))
         for _ in range(300)]


def words(n):
    return [RNG.choice(VOCAB) for _ in range(n)]


def gram_set(text, k=4):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} \
        if w else set()


def linked(a, b, percent=85):
    return bool(a and b) and 100 * len(a & b) >= percent * len(a | b)


def brute(rows, k=4, percent=85):
    sets = [gram_set(t, k) for _, t in rows]
    at = list(range(len(rows)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j], percent):
                at[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [e for j, (e, _) in enumerate(rows)
               if root(j) == root(i) and e is not None] if sets[i] else [d]
        out.append((d, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=str)


def corpus():
    rows = [r for r in EDGE]
    n = 1000
    for size in (1, 3, 4, 5, 20, 60, 150):
        for _ in range(4):
            base = words(size)
            rows.append((n := n + 1, " ".join(base)))
            for edits in (0, 1, 1, 2, 3, 5):
                v = list(base)
                for _ in range(edits):
                    at = RNG.randrange(len(v) + 1)
                    v[at:at + 1] = RNG.choice(([], words(1), words(2)))
                rows.append((n := n + 1, "\t".join(v).upper()))
    hub = words(120)                       # a crowd around one text
    for _ in range(90):
        v = list(hub)
        for _ in range(RNG.randint(1, 6)):
            v[RNG.randrange(len(v))] = RNG.choice(VOCAB)
        rows.append((n := n + 1, " ".join(v)))
    line = words(12)                       # a line that many texts share
    for _ in range(60):
        rows.append((n := n + 1, " ".join(line + words(RNG.randint(0, 9)))))
    RNG.shuffle(rows)
    return rows


@pytest.mark.parametrize("stars,leaf", [(3, 64), (0, 5)])
def test_equals_brute_force(make_docs, monkeypatch, stars, leaf):
    monkeypatch.setattr(count_tree, "STAR_ROUNDS", stars)
    monkeypatch.setattr(count_tree, "LEAF", leaf)
    rows = corpus()
    got = near_duplicates(make_docs(rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_all_pairs(make_docs):
    rows = corpus()
    pairs, members = similar_pairs(make_docs(rows))
    tag = {}
    for _, t in rows:
        tag[count_tree.set_tag(shingles(t or "", 4))] = gram_set(t)
    want = {(a, b) for a in tag for b in tag
            if a < b and linked(tag[a], tag[b])}
    assert {(bytes(r.a), bytes(r.b)) for r in pairs.collect()} == want
    assert members.count() == len(rows)


def test_stage_keeps_one_of_each_component(make_docs):
    rows = corpus()
    docs = make_docs(rows)
    out = deduplicate(docs)
    assert out.columns == docs.columns
    want = {(d, c) for d, _, c in brute(rows, 5, 80) if d == c}
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted(
        (d for d, _ in want), key=str)


def test_empty_table(make_docs):
    assert near_duplicates(make_docs([])).count() == 0
