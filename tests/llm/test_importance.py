from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import pytest

from runledger.llm import importance
from runledger.llm.importance import Hasher, ranked, resample, word_lists
from tests.llm.conftest import EDGE

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lower)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def brute(rows, target):
    own, want = [0] * 10_000, [0] * 10_000
    for counts, texts in ((own, [t for _, t in rows]), (want, target)):
        for t in texts:
            for f in features(t)[1]:
                counts[bucket(f)] += 1
    size, wanted = sum(own), sum(want)
    gain = [math.floor(1000 * math.log((t + 1) * (size + 10_000) / (
        (s + 1) * (wanted + 10_000)))) for s, t in zip(own, want)]
    out = []
    for i, t in rows:
        words, f = features(t)
        weight = math.floor(sum(gain[bucket(x)] for x in f) / len(f)) \
            if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode())
                .hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log(
            (h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, weight + noise, None, len(words)])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (
        -r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:len(able) * 25 // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def corpus():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(60)] + ["Été", "ÀB", "x_y", "a-b", "😀q"]
    rows = list(EDGE)
    rows += [(1000 + k, " ".join(rng.choices(words, k=rng.randint(0, 60))))
             for k in range(150)]
    rows += [(2000 + k, "one two, THREE! " * 30) for k in range(40)]
    rows += [(3000, "z" * 40 + " " + "long " * 200), (3000, "again " * 30)]
    rows += [(3001, "again " * 30)] * 3
    return rows


TARGET = ["one two three four", "w1 w2 w3 w1 w2", None, "", "été x y"]


def result(df):
    return sorted(map(tuple, df.select(
        "doc_id", "n_features", "weight", "score", "rank").collect()),
        key=str)


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame(
        [(k, t, 1) for k, t in enumerate(TARGET)],
        "item_id long, text string, n long")


def test_equals_brute_force(make_docs, target):
    assert result(ranked(make_docs(corpus()), target)) == brute(
        corpus(), TARGET)


def test_head_never_changes_a_bucket():
    """Words and pairs of the head, of the tail, and of both."""
    text = ("aa bb cc dd aa bb ée " * 50).encode()
    want = [bucket(f) for f in features(text.decode())[1]]
    words = [b"aa", b"cc", b"bb", b"unseen"]
    text += b" " + b"q" * 40 + b" cc " + b"z" * 90 + b" aa " + b"y" * 48
    want = [bucket(f) for f in features(text.decode())[1]]
    for w, p in (([], []), (words, []), (words, [(0, 2)]),
                 (words, [(2, 1), (3, 3), (0, 2), (1, 0)])):
        got = [x for part in Hasher(w, p).buckets(text) for y in part
               for x in y.tolist()]
        assert sorted(got) == sorted(want)


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(importance, "PIECE", 50)
    for text in ("", " ", "x" * 400, "ab é " * 200, "y" * 60 + " ab",
                 " " * 130 + "z", "ab " * 16 + "c " + "dd " * 40):
        words, wanted = features(text)
        lists = list(word_lists(text.encode()))
        got = [w for k, x in enumerate(lists) for w in x[min(k, 1):]]
        assert got == [w.encode() for w in words]
        found = [x for part in Hasher([], []).buckets(text.encode())
                 for y in part for x in y.tolist()]
        assert sorted(found) == sorted(map(bucket, wanted))


def test_resample_prefers_the_target(make_docs, spark):
    rng = random.Random(2)
    a = [f"alpha{k}" for k in range(40)]
    b = [f"beta{k}" for k in range(40)]
    rows = [(k, " ".join(rng.choices(a if k % 4 == 0 else b, k=40)))
            for k in range(200)]
    docs = make_docs(rows)
    wanted = spark.createDataFrame(
        [(0, " ".join(rng.choices(a, k=400)))], "item_id long, text string")
    out = resample(docs, wanted)
    assert out.columns == docs.columns
    got = [r.doc_id for r in out.collect()]
    # A quarter of the rows is like the target, well over half of the draw.
    assert len(got) == 50 and sum(i % 4 == 0 for i in got) >= 30


def test_empty_tables(make_docs, target):
    assert result(ranked(make_docs([]), target)) == []
    rows = EDGE + [(9, "nothing to aim at " * 9)] * 4
    assert result(ranked(make_docs(rows), target.limit(0))) == brute(rows, [])
