"""Operator 2: toxicity by multiple-instance learning.

A document is a bag of sentences.  A linear model over hashed words and word
beginnings gives each sentence a probability; the document's probability is
their noisy-or, ``1 - prod(1 - p)``.  Only document labels are needed: the
gradient of the noisy-or says which sentences to blame.  Training is full-batch
proximal gradient descent (absolute-value penalty, so few features stay): each
round is one Spark job that sums gradients over the partitions of the training
rows, so only vectors of fixed width travel.  The model then scores every
document and locates its offending sentences.

The training rows are at most ``TRAIN_ROWS`` labelled documents per class,
drawn by hash; a row with ``held_out`` true is never trained on.  Inputs of a
score are the text alone.

Defined results: a null or empty text scores as one sentence without words;
documents with several labels count as toxic if one of them says so; a label
that is null is none; null ids are scored and never trained on; repeated rows
are scored one by one; without labels of both classes all scores stay at the
starting value; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import (
    CACHED_LENGTH, crc_remainder, doc_texts, stored)
from runledger.llm.linear import sigmoid

TRAIN_ROWS = 8_000      # bound per class
TRAIN_TASKS = 6         # tasks of a gradient round over the bounded rows
WIDTH = 1 << 18
ROUNDS = 60
RATE, BIAS_RATE, MOMENTUM = 10.0, 1.0, 0.9
SPARSITY = 1e-3         # weight of the absolute values in the loss
START = -6.0            # bias before training: few sentences offend
LEAST_DOCS = 5          # documents a trained feature occurs in
MOST_CLEAN = 0.1        # share of the clean documents it may occur in
THRESHOLD = 0.7
OFFENDING = 0.5         # probability from which a sentence is reported
CACHE_ENTRIES = 400_000

SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
WORD = re.compile(r"\w+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(crc_remainder(doc_id, 3) == 1, F.lit(True))


def word_features(word: str) -> tuple[int, ...]:
    """The hashed word and its beginnings of three and four letters."""
    return tuple(zlib.crc32(f.encode("utf-8", "surrogatepass")) % WIDTH
                 for f in (word, "^" + word[:3], "^" + word[:4]))


def sentences(text: str) -> list[tuple[int, int, list[str]]]:
    """(start, end, lower-cased words); an empty text is one sentence."""
    out = [(m.start(), m.end(), WORD.findall(m.group().lower()))
           for m in SENTENCE.finditer(text)]
    out = [s for s in out if s[2]]
    return out or [(0, 0, [])]


_FEATURES: dict[str, tuple[int, ...]] = {}


def _featurize(rows: DataFrame) -> DataFrame:
    """label, lens (features per sentence) and idx of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lens, idx = [], []
            for text in batch.column(1):
                doc = []
                sizes = []
                for _, _, words in sentences(text.as_py()):
                    sizes.append(3 * len(words))
                    for w in words:
                        f = _FEATURES.get(w)
                        if f is None:
                            if len(_FEATURES) > CACHE_ENTRIES:
                                _FEATURES.clear()
                            f = word_features(w)
                            if len(w) <= CACHED_LENGTH:
                                _FEATURES[w] = f
                        doc += f
                lens.append(sizes)
                idx.append(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lens, pa.list_(pa.int32())),
                 pa.array(idx, pa.list_(pa.int32()))],
                ["label", "lens", "idx"])

    return rows.select("label", "text").mapInArrow(
        run, "label int, lens array<int>, idx array<int>")


def bag_gradient(w: np.ndarray, label: np.ndarray, weight: np.ndarray,
                 doc: np.ndarray, lens: np.ndarray, idx: np.ndarray
                 ) -> tuple[np.ndarray, float]:
    """Gradient and loss of the noisy-or log-likelihood.  ``doc`` is the
    document of each sentence, the last weight is the bias."""
    sent = np.repeat(np.arange(len(lens)), lens)
    z = np.bincount(sent, w[idx], len(lens)) + w[-1]
    p = sigmoid(z)
    log_q = -np.bincount(doc, np.logaddexp(0, z), len(label))
    q = np.exp(log_q)
    pos = np.maximum(-np.expm1(log_q), 1e-12)
    # d loss / d z of a sentence: p in clean documents, -p q/(1-q) else.
    blame = np.where(label == 1, -q / pos, 1.0) * weight
    g = p * blame[doc]
    grad = np.bincount(idx, g[sent], len(w))
    grad[-1] += g.sum()
    loss = -(weight * np.where(label == 1, np.log(pos), log_q)).sum()
    return grad, float(loss)


def _summed(table: DataFrame, part) -> np.ndarray:
    """Sum over the partitions of the vectors that ``part`` makes of their
    batches; vectors travel as their non-zero places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(WIDTH + 1)
        for batch in batches:
            total += part(batch)
        at = np.nonzero(total)[0].astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([at.tobytes()]), pa.array([total[at].tobytes()])],
            ["at", "value"])

    out = np.zeros(WIDTH + 1)
    rows = table.mapInArrow(run, "at binary, value binary").collect()
    for r in sorted(rows):   # a fixed order: the same sum in every run
        out[np.frombuffer(r["at"], np.int32)] += np.frombuffer(
            r["value"], np.float64)
    return out


def _bag(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """label, document of each sentence, sentence lengths, features."""
    lens, idx = batch.column(1), batch.column(2)
    return (batch.column(0).to_numpy(zero_copy_only=False),
            np.repeat(np.arange(len(lens)),
                      np.diff(lens.offsets.to_numpy())),
            lens.flatten().to_numpy(zero_copy_only=False),
            idx.flatten().to_numpy(zero_copy_only=False))


def _documents_with(batch: pa.RecordBatch, toxic: int) -> np.ndarray:
    """Number of documents of one class that hold each feature."""
    label, doc, lens, idx = _bag(batch)
    of = doc[np.repeat(np.arange(len(lens)), lens)].astype(np.int64)
    pairs = np.unique(idx.astype(np.int64) * len(label) + of)
    pairs = pairs[label[pairs % len(label)] == toxic]
    return np.bincount(pairs // len(label), minlength=WIDTH + 1)


def train(rows: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (the last one is the bias) from rows (label, text)."""
    # Bounded by the sample: a few tasks, or each would send a vector.  The
    # scan that finds the sample keeps all its tasks.
    table = stored(_featurize(rows.repartition(TRAIN_TASKS)),
                   "toxic-features")
    size = {r["label"]: r["count"]
            for r in table.groupBy("label").count().collect()}
    w = np.zeros(WIDTH + 1)
    w[-1] = START
    if len(size) < 2:
        return w
    class_weight = np.array([0.5 / size[0], 0.5 / size[1]])
    # The upper cut is by the clean class alone, so that it depends neither
    # on the mix of the sample nor on how many toxic documents hold a word.
    clean, toxic = (_summed(table, lambda batch, c=c: _documents_with(
        batch, c)) for c in (0, 1))
    rate = RATE * ((clean + toxic >= LEAST_DOCS) & (
        clean <= MOST_CLEAN * size[0]))
    rate[-1] = BIAS_RATE
    speed = np.zeros(WIDTH + 1)
    sc = table.sparkSession.sparkContext
    for _ in range(rounds):
        model = sc.broadcast(w)

        def part(batch: pa.RecordBatch, model=model) -> np.ndarray:
            label, doc, lens, idx = _bag(batch)
            return bag_gradient(model.value, label, class_weight[label], doc,
                                lens, idx)[0]

        speed = MOMENTUM * speed + rate * _summed(table, part)
        w = w - speed
        w[:-1] = np.sign(w[:-1]) * np.maximum(
            np.abs(w[:-1]) - RATE * SPARSITY, 0)
        model.unpersist()
    return w


def training_rows(docs: DataFrame, labels: DataFrame,
                  rows: int = TRAIN_ROWS) -> DataFrame:
    """(label, text) of at most ``rows`` documents per class."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("toxic").cast("int").alias("label"))
             .filter("doc_id is not null and label is not null")
             .groupBy("doc_id").agg(F.max("label").alias("label"))
             .filter(~held_out(F.col("doc_id"))))
    drawn = None
    for c in (0, 1):
        one = known.filter(F.col("label") == c).orderBy(
            F.xxhash64("doc_id"), "doc_id").limit(rows)
        drawn = one if drawn is None else drawn.unionByName(one)
    # At most 2 * rows pairs of numbers.
    return doc_texts(docs).join(
        F.broadcast(stored(drawn, "toxic-sample")), "doc_id"
    ).select("label", "text")


def score(docs: DataFrame, w: np.ndarray) -> DataFrame:
    """doc_id, score, n_sentences and the offending sentences (code point
    start and end, probability) of every row."""
    model = docs.sparkSession.sparkContext.broadcast(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.value
        bias = weights[-1]
        known: dict[str, float] = {}
        for batch in batches:
            scores, n, found = [], [], []
            for text in batch.column(1):
                parts = sentences(text.as_py())
                z = []
                for _, _, words in parts:
                    total = bias
                    for word in words:
                        x = known.get(word)
                        if x is None:
                            if len(known) > CACHE_ENTRIES:
                                known.clear()
                            x = float(sum(
                                weights[i] for i in word_features(word)))
                            if len(word) <= CACHED_LENGTH:
                                known[word] = x
                        total += x
                    z.append(total)
                za = np.array(z)
                p = sigmoid(za)
                scores.append(float(-np.expm1(-np.logaddexp(0, za).sum())))
                n.append(len(parts))
                found.append([
                    {"start": parts[k][0], "end": parts[k][1],
                     "probability": float(p[k])}
                    for k in np.nonzero(p >= OFFENDING)[0]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()),
                 pa.array(n, pa.int32()), pa.array(found, pa.list_(pa.struct(
                     [("start", pa.int32()), ("end", pa.int32()),
                      ("probability", pa.float64())])))],
                ["doc_id", "score", "n_sentences", "offending"])

    return doc_texts(docs).mapInArrow(
        run, "doc_id long, score double, n_sentences int, offending "
             "array<struct<start:int,end:int,probability:double>>")


def toxicity(docs: DataFrame, labels: DataFrame,
             threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, n_sentences, offending."""
    w = train(training_rows(docs, labels))
    return score(docs, w).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "n_sentences", "offending")
