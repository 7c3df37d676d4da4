"""Operator 13: importance resampling towards a target distribution.

Features are the words of a text and its pairs of consecutive words, each
hashed to a bucket by CRC-32.  The buckets' totals over all documents and over
the target texts give every bucket a gain (a log ratio); a document's weight is
the mean gain of its features, and Gumbel noise keyed by its id turns the
weights into a draw without replacement: the highest scores are drawn.

Head-tail vocabulary: the words and pairs seen most often are counted in one
pass over all texts (each task keeps a bounded table of counts) and sent to
every task, which has the CRC states of the words and the buckets of the
pairs.  All others, the tail, take the CRC of their own bytes (that of a pair
continues from the state of its first word).  Both give the same numbers, so
the totals are exact whatever is in the head; its choice only saves time.  The
head is bounded by ``HEAD_WORDS``, ``HEAD_PAIRS`` and ``HEAD_BYTES`` a word.

Defined results: null and empty texts have no features, weight 0 and a score
of noise alone; a null doc_id counts as the empty string in the noise and
comes last among ties; rows are scored and drawn one by one, so repeated rows
get ranks of their own; very long texts are read in pieces; no documents give
an empty result and no target texts a target without features.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import numbered, row_key, rows_of, stored

BUCKETS = 10_000
SEED = 7
PERCENT = 25
LEAST_WORDS = 20
HEAD_WORDS = 20_000
HEAD_PAIRS = 100_000
HEAD_BYTES = 48       # longer words are left to the tail
COUNTED = 1_000_000   # entries of a task's tables of counts
PIECE = 1 << 20       # bytes of a text that are cut into words at once

# ASCII letters to lower case; every other ASCII byte but digits parts words.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122
    or c >= 128 else 32 for c in range(256))


def word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size.  Each list but the
    first starts with the last word of the one before."""
    start, last = 0, []
    while start < len(text):
        end = start + PIECE
        piece = text[start:end].translate(_TABLE)
        while end < len(text) and not piece.endswith(b" "):
            more = text[end:end + 4096].translate(_TABLE)
            cut = more.find(b" ") + 1 or len(more)
            piece, end = piece + more[:cut], end + cut
        words = piece.split()
        if words:
            yield last + words
            last = words[-1:]
        start = end


def _shifts() -> np.ndarray:
    """[n, k, v]: what byte k with value v of a CRC turns to when n bytes
    follow.  CRCs are linear, so the CRC of two strings joined is that of the
    first, so shifted, exclusive-or that of the second."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320),
                         table >> 1)
    step = np.arange(256, dtype=np.uint32) << (
        8 * np.arange(4, dtype=np.uint32)[:, None])
    out = [step]
    for _ in range(HEAD_BYTES + 1):
        step = (step >> 8) ^ table[step & 255]
        out.append(step)
    return np.array(out)


def _follow(shifts: np.ndarray, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = shifts[n, 0, crc & 255]
    for k in (1, 2, 3):
        out ^= shifts[n, k, (crc >> (8 * k)) & 255]
    return out


class Hasher:
    """Buckets of a text's features, by head and tail."""

    def __init__(self, words: list[bytes], pairs: list[tuple[int, int]]):
        self.place = {w: k for k, w in enumerate(words)}
        self.states = np.array([*map(zlib.crc32, words), 0], np.uint32)
        self.size = len(words) + 1
        codes = np.array([a * self.size + b for a, b in pairs], np.int64)
        order = np.argsort(codes)
        self.pairs = np.append(codes[order], np.iinfo(np.int64).max)
        self.pair_buckets = np.array(
            [zlib.crc32(words[a] + b" " + words[b]) % BUCKETS
             for a, b in pairs] + [0], np.int64)[[*order, len(pairs)]]
        self.shifts = _shifts()
        space = np.full(HEAD_BYTES + 1, zlib.crc32(b" "), np.uint32)
        self.spaces = _follow(self.shifts, space, np.arange(HEAD_BYTES + 1))

    def buckets(self, text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Buckets of words and of pairs, piece by piece."""
        for k, words in enumerate(word_lists(text)):
            n = len(words)
            place = np.fromiter(map(self.place.get, words, repeat(-1)),
                                np.int64, n)
            crc = self.states[place]
            tail = np.nonzero(place < 0)[0]
            crc[tail] = [zlib.crc32(words[i]) for i in tail.tolist()]
            yield (crc[min(k, 1):].astype(np.int64) % BUCKETS,
                   self._pairs(words, place, crc))

    def _pairs(self, words: list[bytes], place: np.ndarray, crc: np.ndarray
               ) -> np.ndarray:
        a, b = place[:-1], place[1:]
        code = np.where((a < 0) | (b < 0), -1, a * self.size + b)
        at = np.searchsorted(self.pairs, code)
        out = self.pair_buckets[at]
        tail = np.nonzero(self.pairs[at] != code)[0]
        # The tail: the first's state, a blank and the bytes of the second.
        n = np.fromiter((len(words[i + 1]) for i in tail.tolist()), np.int64,
                        len(tail))
        short = n <= HEAD_BYTES
        some, n = tail[short], n[short]
        out[some] = (_follow(self.shifts, crc[some], n + 1) ^ self.spaces[n]
                     ^ crc[some + 1]).astype(np.int64) % BUCKETS
        for i in tail[~short].tolist():
            out[i] = zlib.crc32(b" " + words[i + 1], int(crc[i])) % BUCKETS
        return out


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for t in batch.column("text"):
        yield t.as_buffer().to_pybytes() if t.is_valid else b""


def _pruned(counts: Counter) -> None:
    """Drop the lowest counts, and half of the entries at least."""
    most, least = len(counts) // 2, 0
    while len(counts) > most:
        least += 1
        kept = {k: n for k, n in counts.items() if n > least}
        counts.clear()
        dict.update(counts, kept)


def head(docs: DataFrame) -> tuple[list[bytes], list[tuple[int, int]]]:
    """Frequent words, and frequent pairs of them by their places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = Counter(), Counter()
        for batch in batches:
            for text in _texts(batch):
                for k, found in enumerate(word_lists(text)):
                    words.update(found[min(k, 1):])
                    pairs.update(zip(found, found[1:]))
                    for counts in (words, pairs):
                        if len(counts) > COUNTED:
                            _pruned(counts)
        top = [(w, None, n) for w, n in words.most_common(HEAD_WORDS)
               if len(w) <= HEAD_BYTES]
        top += [(a, b, n) for (a, b), n in pairs.most_common(HEAD_PAIRS)
                if max(len(a), len(b)) <= HEAD_BYTES]
        yield pa.RecordBatch.from_arrays(
            [pa.array([t[0] for t in top], pa.binary()),
             pa.array([t[1] for t in top], pa.binary()),
             pa.array([t[2] for t in top], pa.int64())], ["a", "b", "n"])

    counts = stored(docs.select("text").mapInArrow(
        run, "a binary, b binary, n long").groupBy("a", "b").agg(
        F.sum("n").alias("n")), "importance-head")

    def most(rows: DataFrame, n: int) -> list:
        """The rows with the highest counts, ``n`` at most.  A histogram by
        powers of 2 ** (1 / 8) has the least count; so no task sends more
        than its share of them."""
        power = F.floor(F.log2("n") * 8).cast("int")
        sizes = {r["power"]: r["count"] for r in rows.groupBy(
            power.alias("power")).count().collect()}
        least, total = None, 0
        for p in sorted(sizes, reverse=True):
            total += sizes[p]
            if total > n:
                break
            least = p
        return [] if least is None else rows.filter(power >= least).collect()

    words = [bytes(r["a"]) for r in most(counts.filter("b is null"),
                                         HEAD_WORDS)]
    place = {w: k for k, w in enumerate(words)}
    pairs = [(place.get(bytes(r["a"])), place.get(bytes(r["b"])))
             for r in most(counts.filter("b is not null"), HEAD_PAIRS)]
    return words, [p for p in pairs if None not in p]


def totals(texts: DataFrame, vocabulary) -> np.ndarray:
    """Features in each bucket, over all rows (column text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(*vocabulary.value)
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in _texts(batch):
                for found in hasher.buckets(text):
                    for part in found:
                        total += np.bincount(part, minlength=BUCKETS)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for r in texts.select("text").mapInArrow(
            run, "bucket long, n long").groupBy("bucket").agg(
            F.sum("n").alias("n")).collect():   # at most BUCKETS rows
        out[r["bucket"]] = r["n"]
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of each bucket's share in the target and in the documents,
    in thousandths."""
    size, wanted = float(own.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log(
        (t + 1) * size / ((s + 1) * wanted)))
        for s, t in zip(own.tolist(), target.tolist())], np.int64)


def scored(docs: DataFrame, target: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score (and key, the row's name)
    of every row."""
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(head(docs))
    gain = gains(totals(docs, vocabulary), totals(target, vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(*vocabulary.value)
        for batch in batches:
            words, features, weights = [], [], []
            for text in _texts(batch):
                n = m = total = 0
                for one, two in hasher.buckets(text):
                    n, m = n + len(one), m + len(two)
                    total += int(gain[one].sum()) + int(gain[two].sum())
                words.append(n)
                features.append(n + m)
                weights.append(total // (n + m) if n else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"),
                 *[pa.array(x, pa.int64()) for x in (words, features,
                                                     weights)]],
                ["doc_id", "key", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       row_key(docs).alias("key"), "text").mapInArrow(
        run, "doc_id long, key long, n_words long, n_features long, "
             "weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(
        F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16,
               10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return rows.withColumn("score", F.col("weight") + noise)


def ranked(docs: DataFrame, target: DataFrame, seed: int = SEED,
           percent: int = PERCENT, least_words: int = LEAST_WORDS
           ) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null: not drawn), key of
    every row."""
    rows = stored(scored(docs, target, seed), "importance-scores")
    able = F.col("n_words") >= least_words
    draw = rows.filter(able).count() * percent // 100
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    columns = ["doc_id", "n_features", "weight", "score", "key"]
    drawn = numbered(rows.filter(able).select(*columns), [], order, "rank")
    none = F.lit(None).cast("long")
    return drawn.select(*columns, F.when(
        F.col("rank") <= draw, F.col("rank")).alias("rank")).unionByName(
        rows.filter(~able).select(*columns, none.alias("rank")))


def resample(docs: DataFrame, target: DataFrame, **params) -> DataFrame:
    """The drawn rows of ``docs``, with all their columns.  Rows that repeat
    a drawn row's id and text come with it."""
    drawn = ranked(docs, target, **params).filter("rank is not null")
    return rows_of(docs, drawn.select(F.col("key").alias("doc_id")))
