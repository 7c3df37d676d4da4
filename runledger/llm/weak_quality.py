"""Operator 8: quality classifier from weak labels.

Eleven overlapping heuristics vote good, junk or abstain on every document.
Expectation-maximisation estimates how often each heuristic votes what on good
and on junk documents, with no labels; an abstention says nothing.  It works on the counts of the vote
patterns over all documents, of which there are at most 3 ** 11, so it reads
the corpus once whatever its size.  The posterior of a document's pattern is
its soft label, and trains a linear scorer over hashed features: the shapes of
its words (character classes, run-length compressed) and coarse levels of its
statistics.  The scorer is fitted on ``TRAIN_ROWS`` documents at most, drawn
by hash; every document is scored.

Defined results: a null or empty text has a junk vote for having no word and
no other vote; null ids, repeated rows and extra columns are scored row by row; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import (
    at_work, doc_texts, give_back, keyed, rows_of, stored)
from runledger.llm.linear import Adam, sigmoid

TRAIN_ROWS = 20_000   # bound of the sample that the scorer is fitted on
WIDTH = 1 << 14
THRESHOLD = 0.5
EM_ROUNDS = 60
ADAM_ROUNDS = 150
# Prior on the rate of junk votes on good documents: its value, and its
# weight in multiples of the good documents.  Without it, a rare kind of junk
# that few heuristics see is explained as good documents with odd votes.
PRIOR_RATE, PRIOR_WEIGHT = 0.005, 5.0
SEGMENT = 400      # words
SLICE_ROWS = 500   # whose features are Python lists at the same time

# Frequent function words of the four languages.
FUNCTION_WORDS = frozenset("""
the of and to in is that for it as was with be by on not he this are or from
der die und den von zu das mit sich des auf ist im dem nicht ein eine als auch
de la le et les des en un du une que est pour qui dans par plus pas sur au
el los del se las con no una su lo como al es más para
""".split())

_LOWER = re.compile(r"[a-zà-öø-ÿ]+")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_DIGIT = re.compile(r"\d+")
_REPEAT = re.compile(r"([^\w\s])\1+")
_EDGES = ".,;:!?\"'()[]{}"


def variety(words: list[str]) -> float:
    """Mean share of different words in equal stretches of a text, each of
    SEGMENT words or fewer (the share falls with a stretch's length)."""
    parts = max(1, -(-len(words) // SEGMENT))
    cuts = [k * len(words) // parts for k in range(parts + 1)]
    return sum(len(set(words[a:b])) / max(1, b - a)
               for a, b in zip(cuts, cuts[1:])) / parts


def statistics(text: str) -> tuple[list[str], dict[str, float]]:
    """Words, and the figures the heuristics look at."""
    words = text.split()
    n = max(1, len(words))
    plain = [w.strip(_EDGES).lower() for w in words]
    letters = sum(map(len, _LOWER.findall(text)))
    upper = sum(map(len, _UPPER.findall(text)))
    counts = Counter(plain)
    visible = max(1, sum(map(len, words)))
    ends = sum(1 for w in words if w[-1] in ".!?")
    loud = sum(1 for w in words if w[-1] == "!")
    tails = sum(1 for w in words if len(w) > 2 and w[-1] == w[-2] != "."
                and not w[-1].isalnum())
    return words, {
        "words": len(words),
        "symbols": sum(text.count(c) for c in "#$%&*|~^@<>=\\") / visible,
        "upper": upper / max(1, upper + letters),
        "function": sum(c for w, c in counts.items()
                        if w in FUNCTION_WORDS) / n,
        "echo": sum(1 for a, b in zip(plain, plain[1:]) if a == b) / n,
        "top": max((c for w, c in counts.items()
                    if w not in FUNCTION_WORDS), default=0) / n,
        "distinct": variety(plain),
        "alone": sum(1 for w in words if not any(map(str.isalnum, w))) / n,
        "sentence": ends / n,
        "loud": loud / n,
        "tails": tails / n,
    }


def votes(s: dict[str, float]) -> list[int]:
    """1 good, -1 junk, 0 abstains; one vote of each heuristic."""

    def vote(junk: bool, good: bool) -> int:
        return -1 if junk else 1 if good else 0

    few, some = s["words"] >= 3, s["words"] >= 30
    return [
        vote(s["words"] == 0, False),
        vote(few and s["loud"] > 0.2, few and s["loud"] < 0.05),
        vote(few and s["tails"] > 0.1, few and s["tails"] < 0.03),
        vote(few and s["symbols"] > 0.08, few and s["symbols"] < 0.02),
        vote(few and s["upper"] > 0.5, few and s["upper"] < 0.2),
        vote(few and s["alone"] > 0.2, few and s["alone"] < 0.05),
        vote(some and s["function"] < 0.02, some and s["function"] > 0.1),
        vote(few and s["echo"] > 0.25, few and s["echo"] < 0.05),
        vote(some and s["top"] > 0.2, some and s["top"] < 0.1),
        vote(some and s["sentence"] > 0.4, some and s["sentence"] < 0.3),
        vote(some and s["distinct"] < 0.35, some and s["distinct"] > 0.5),
    ]


def shape(word: str) -> str:
    word = _LOWER.sub("a", word)
    word = _UPPER.sub("B", word)
    return _REPEAT.sub(r"\1\1", _DIGIT.sub("0", word))


def features(text: str, shapes: dict[str, str] | None = None
             ) -> tuple[list[int], list[int], list[float]]:
    """Votes, hashed feature numbers and their values for one text."""
    words, s = statistics(text)
    shapes = {} if shapes is None else shapes
    counts: Counter[str] = Counter()
    for w, c in Counter(words).items():
        f = shapes.get(w)
        if f is None:
            if len(shapes) > 300_000:
                shapes.clear()
            f = sys.intern(shape(w))    # few, of many words
            if len(w) <= 64:    # bounds the cache's bytes
                shapes[w] = f
        counts[f] += c
    n = max(1, len(words))
    named = {f"shape {f}": min(1.0, 4.0 * c / n) for f, c in counts.items()
             if c * 100 >= n}
    for k, v in s.items():
        level = np.log2(1 + v) if k == "words" else v * 20
        named[f"{k} {int(min(20, level))}"] = 1.0
    hashed: dict[int, float] = {}
    for f, v in named.items():
        at = xxhash.xxh64_intdigest(f) % WIDTH
        hashed[at] = hashed.get(at, 0.0) + v
    return votes(s), list(hashed), list(hashed.values())


_SHAPES: dict[str, str] = {}


def _featurized(batch: pa.RecordBatch) -> pa.RecordBatch:
    shapes = at_work(_SHAPES)
    got = [features(t.as_py(), shapes) for t in batch.column(2)]
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1),
         pa.array([g[0] for g in got], pa.list_(pa.int8())),
         pa.array([g[1] for g in got], pa.list_(pa.int32())),
         pa.array([g[2] for g in got], pa.list_(pa.float32()))],
        ["row_no", "doc_id", "votes", "idx", "val"])


def featurize(docs: DataFrame) -> DataFrame:
    """row_no, doc_id, votes, idx, val for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), SLICE_ROWS):
                yield _featurized(batch.slice(at, SLICE_ROWS))
            give_back()

    rows = doc_texts(docs).select(
        F.monotonically_increasing_id().alias("row_no"), "doc_id", "text")
    return rows.mapInArrow(run, "row_no long, doc_id long, "
                                "votes array<byte>, idx array<int>, "
                                "val array<float>")


def estimate(patterns: np.ndarray, counts: np.ndarray,
             rounds: int = EM_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns.  Returns the posterior of "good" per pattern
    and, per class and heuristic, its rate of junk votes where it votes."""
    good, junk = patterns > 0, patterns < 0
    # Start: one junk vote outweighs the good votes, none leaves it good.
    post = np.where(junk.any(axis=1), 0.02, 0.9)
    rates = np.zeros((2, patterns.shape[1]))
    for _ in range(rounds):
        logs = np.zeros((len(patterns), 2))
        for c, weight in ((1, counts * post), (0, counts * (1 - post))):
            # Smoothing: what a heuristic never did remains possible.
            bad, fine = weight @ junk + 0.5, weight @ good + 0.5
            if c:   # the heuristics are built to spare good documents
                bad = bad + PRIOR_WEIGHT * weight.sum() * PRIOR_RATE
                fine = fine + PRIOR_WEIGHT * weight.sum() * (1 - PRIOR_RATE)
            rates[c] = bad / (bad + fine)
            logs[:, c] = (np.log(weight.sum() + 1.0)
                          + junk @ np.log(rates[c])
                          + good @ np.log(1 - rates[c]))
        post = sigmoid(logs[:, 1] - logs[:, 0])
    return post, rates


def fit(rows: DataFrame) -> tuple[np.ndarray, float]:
    """Weights and bias of the scorer, from featurized rows."""
    table = rows.groupBy("votes").count().collect()  # at most 3 ** 11 rows
    if not table:
        return np.zeros(WIDTH), 0.0
    table.sort(key=lambda r: r["votes"])
    patterns = np.array([r["votes"] for r in table])
    post, _ = estimate(patterns, np.array([r["count"] for r in table], float))
    label = {tuple(p): q for p, q in zip(patterns.tolist(), post)}

    n = sum(r["count"] for r in table)
    part = F.pmod(F.xxhash64("row_no", "doc_id"), F.lit(1 << 30))
    drawn = (rows.select("votes", "idx", "val", "row_no", part.alias("p"))
             .filter(F.col("p") < int(min(1.0, TRAIN_ROWS / n) * (1 << 30)))
             .orderBy("p", "row_no").limit(2 * TRAIN_ROWS).collect())
    y = np.array([label[tuple(r["votes"])] for r in drawn])
    doc = np.repeat(np.arange(len(drawn)), [len(r["idx"]) for r in drawn])
    idx = np.array([i for r in drawn for i in r["idx"]], int)
    val = np.array([v for r in drawn for v in r["val"]])
    w, bias = np.zeros(WIDTH + 1), WIDTH
    # Both classes weigh the same, so that rare junk is learnt.
    share = min(max(y.mean(), 0.01), 0.99) if len(y) else 0.5
    weight = (y / share + (1 - y) / (1 - share)) / 2
    adam = Adam(WIDTH + 1, 0.1)
    for _ in range(ADAM_ROUNDS):
        z = np.bincount(doc, w[idx] * val, len(drawn)) + w[bias]
        g = (sigmoid(z) - y) * weight / max(1, len(drawn))
        grad = np.bincount(idx, g[doc] * val, WIDTH + 1) + 1e-5 * w
        grad[bias] += g.sum()
        adam.step(w, grad)
    return w[:-1], float(w[bias])


def quality(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score (0 junk to 1 good), kept, and the number of heuristics
    that voted junk and good, for every row."""
    rows = stored(featurize(docs), "quality-features")
    w, b = fit(rows)
    model = docs.sparkSession.sparkContext.broadcast(w)  # WIDTH numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.value
        for batch in batches:
            idx, val = batch.column(1), batch.column(2)
            ends = idx.offsets.to_numpy()
            doc = np.repeat(np.arange(len(idx)), np.diff(ends))
            flat = idx.flatten().to_numpy(zero_copy_only=False)
            z = np.bincount(doc, weights[flat] * val.flatten().to_numpy(
                zero_copy_only=False), len(idx)) + b
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sigmoid(z)), batch.column(3),
                 batch.column(4)], ["doc_id", "score", "n_junk", "n_good"])

    scored = rows.select(
        "doc_id", "idx", "val",
        F.size(F.filter("votes", lambda v: v < 0)).alias("n_junk"),
        F.size(F.filter("votes", lambda v: v > 0)).alias("n_good"),
    ).mapInArrow(score, "doc_id long, score double, n_junk int, n_good int")
    return scored.select("doc_id", "score",
                         (F.col("score") >= threshold).alias("kept"),
                         "n_junk", "n_good")


def reject_junk(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score well enough, with all columns."""
    scores = stored(quality(keyed(docs), threshold), "quality-scores")
    return rows_of(docs, scores.filter("kept"))
