from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np

from runledger.llm import suffix_names
from runledger.llm.suffix_names import LENGTH, kept_bytes, remove_repeats
from tests.llm.conftest import EDGE

RNG = random.Random(8)


def noise(n):
    return "".join(RNG.choice("abcdé \n") for _ in range(n))


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + LENGTH] for t in texts
                   for i in range(len(t) - LENGTH + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - LENGTH + 1):
            if seen[t[i:i + LENGTH]] > 1:
                gone[i + 1:i + 1 + LENGTH] = True
        runs = int((gone[1:] & ~gone[:-1]).sum())
        kept = bytes(b for b, g in zip(t, gone[1:]) if not g)
        out.append((d, len(t), int(gone.sum()), runs,
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus():
    rows = [r for r in EDGE if not r[1] or len(r[1]) < 5000]
    a, b = noise(900), noise(260)
    rows += [(20, a), (21, noise(77) + a[100:700] + noise(50)),
             (22, a[:199] + "X" + a[200:399] + "Y"), (23, a[300:500]),
             (24, a[301:500]), (25, b + noise(3) + b), (26, "x" * 450),
             (27, "ab" * 300), (28, "ab" * 120 + noise(80)),
             (29, noise(20) + "x" * 210), (30, "x" * 200), (31, "y" * 200)]
    passage = noise(320)                    # common, other surroundings
    rows += [(100 + k, noise(RNG.randint(0, 300)) + passage
              + noise(RNG.randint(0, 300))) for k in range(40)]
    hub = list(noise(1500))                 # near copies
    for k in range(30):
        v = list(hub)
        for _ in range(k % 7):
            v[RNG.randrange(len(v))] = "#"
        rows.append((200 + k, "".join(v)))
    rows += [(300 + k, noise(600)) for k in range(20)]
    return rows


def result(df):
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans,
                    r.kept_sha256) for r in df.collect()], key=str)


def test_equals_brute_force(make_docs):
    rows = corpus()
    assert result(remove_repeats(make_docs(rows))) == brute(rows)


def test_rows_of_a_shuffle(make_docs):
    """Rows that come in another order in each evaluation keep their texts."""
    rows = corpus() * 2
    assert result(remove_repeats(make_docs(rows).repartition(8))) == brute(
        rows)


def test_long_documents_are_cut_into_blocks(make_docs, monkeypatch):
    """Blocks of 257 window starts (on the driver's side of this test)."""
    monkeypatch.setattr(suffix_names, "BLOCK", 257)
    texts = [t.encode() for _, t in corpus() if t]
    seen = {}
    for i, t in enumerate(texts):
        for data, inside, doc, shift in suffix_names.blocks([i], [t]):
            names = suffix_names.Prefixes(data)
            place, first, last = suffix_names.samples(names, len(data),
                                                      inside)
            for p, a, z in zip(place, first, last):
                assert (doc[a:z + LENGTH] == i).all()
                for w in range(a, z + 1):
                    own = t[w + shift[w]:w + shift[w] + LENGTH]
                    assert len(own) == LENGTH
                    # Equal windows pick the same place, wherever they are.
                    assert seen.setdefault(own, p - w) == p - w
    every = {t[i:i + LENGTH] for t in texts
             for i in range(len(t) - LENGTH + 1)}
    assert set(seen) == every


def test_kept_bytes():
    text = bytes(range(250)) * 4
    assert kept_bytes(text, []) == (text, 0, 0)
    assert kept_bytes(text, [(500, 1), (10, 3), (12, 5)]) == (
        text[:10] + text[216:500] + text[700:], 406, 2)


def test_empty_table(make_docs):
    assert remove_repeats(make_docs([])).count() == 0
