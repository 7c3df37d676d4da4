"""Operator 5: benchmark decontamination by spaced-seed hashing.

Fixed masks ignore some word positions; the hash of the words at the others
is a seed.  Documents yield the same seeds at every position as benchmark
items; a seed join gives (item, alignment) candidates, and a candidate is
verified by comparing item and document word by word around the hit.  An item
leaks where any stretch of at least ``STRETCH`` of its words (or the whole
item, if shorter) has ``SHARE`` of its words equal at that alignment, so
excerpts and substituted words are found while unrelated texts are not.

The seeds lose nothing at the default share.  A shortest such stretch has
fewer than twice ``STRETCH`` words, as one half of a longer one would do; the
masks of each length class leave one seed untouched for every choice of 20 %
substituted words (a test tries all choices).  So items longer than ``WINDOW``
words are compared in windows that overlap by ``WINDOW - STEP`` words, which
hold every shortest stretch.

Only a bitmap of fixed size (``BITMAP_BITS``), filled from the seeds of the
benchmark, is sent to the tasks; it merely saves shuffling seeds that cannot
join.  A larger benchmark fills it up more, which costs time, not results.
The seeds themselves are joined by a shuffle.

Words are runs of letters, digits and underscores, lower-cased.  Defined
results: null and empty texts and items have no words and never match; items
of fewer than ``LEAST`` words carry too little evidence and are never
reported; repeated rows are reported once per id; an empty table on either
side gives no leaks.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import (
    CACHED_LENGTH, at_work, doc_texts, keyed, rows_of, stored)

WINDOW, STEP = 80, 40
STRETCH = 20
LEAST = 5
SHARE = 0.8
SPAN = 9
# The positions that the masks look at, for items of at least so
# many words.  Found by search: as few and as long as leave none out.
MASKS = {
    5: ((0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4), (0, 2, 3, 4)),
    10: ((0, 1, 2, 4, 5), (0, 1, 3, 6, 7), (0, 1, 2, 3, 4)),
    15: ((0, 1, 2, 3, 5, 6), (0, 1, 4, 6, 7, 8), (0, 1, 2, 3, 4, 5),
         (0, 1, 3, 4, 5, 6), (0, 1, 2, 4, 6, 8)),
    20: ((0, 1, 2, 3, 5, 6), (0, 1, 4, 6, 7, 8), (0, 1, 2, 4, 5, 7)),
}
BITMAP_BITS = 1 << 23
SECOND = 23              # the second bit of a seed is taken from here
CHUNK_WORDS = 200_000
REGION_WORDS = 4096
CACHE_ENTRIES = 500_000

WORD = re.compile(r"\w+")
_ODD = np.array([(xxhash.xxh64_intdigest(f"seed {i}") | 1)
                 for i in range(SPAN)], dtype=np.uint64)
_CACHE: dict[str, int] = {}


def word_hashes(text: str) -> list[int]:
    """64-bit hashes of the words of a text (cached per worker)."""
    if len(at_work(_CACHE)) > CACHE_ENTRIES:
        _CACHE.clear()
    out = []
    for w in WORD.findall(text.lower()):
        h = _CACHE.get(w)
        if h is None:
            h = xxhash.xxh64_intdigest(w)
            if len(w) <= CACHED_LENGTH:
                _CACHE[w] = h
        out.append(h)
    return out


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = x + np.uint64(xxhash.xxh64_intdigest(f"mask {salt}"))
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def length_class(n: int) -> int:
    """The key of MASKS for an item of ``n`` words, at least LEAST."""
    return min(n // 5 * 5, STRETCH)


def seed_plan(classes: Iterable[int]) -> list[tuple[int, ...]]:
    """The different masks of some length classes."""
    return sorted({m for c in classes for m in MASKS[c]})


def seeds(words: np.ndarray, plan: list[tuple[int, ...]]
          ) -> Iterator[np.ndarray]:
    """For each mask of the plan, the seed at every start."""
    at = {o: words * _ODD[o] for o in {o for m in plan for o in m}}
    for mask in plan:
        n = max(0, len(words) - mask[-1])
        acc = np.zeros(n, np.uint64)
        for o in mask:
            acc += at[o][o:o + n]
        yield _mix(acc, sum(1 << o for o in mask))


def _as_long(x: np.ndarray) -> list[int]:
    return x.view(np.int64).tolist()


def benchmark_windows(items: DataFrame, id_col: str = "item_id"
                      ) -> DataFrame:
    """window_id, item_id, words (hashes) of every window of every item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for item, text in zip(batch.column(0).to_pylist(),
                                  batch.column(1).to_pylist()):
                words = word_hashes(text)
                for at in range(0, max(1, len(words) - STEP), STEP):
                    part = np.array(words[at:at + WINDOW], np.uint64)
                    if len(part) >= LEAST:
                        out.append((item, at, _as_long(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int64()),
                 pa.array([r[1] for r in out], pa.int32()),
                 pa.array([r[2] for r in out], pa.list_(pa.int64()))],
                ["item_id", "item_start", "words"])

    rows = items.select(F.col(id_col).cast("long").alias("item_id"),
                        F.coalesce("text", F.lit("")).alias("text"))
    # Repeated items and windows are sought once.
    return rows.mapInArrow(
        cut, "item_id long, item_start int, words array<long>").groupBy(
        "words").agg(F.min(F.struct("item_id", "item_start")).alias("of")) \
        .select(F.xxhash64("words").alias("window_id"), "of.*", "words")


def _window_seeds(windows: DataFrame) -> DataFrame:
    """seed, window_id, pos: where each seed stands in its window."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seed, win, pos = [], [], []
            for w, words in zip(batch.column(0).to_pylist(),
                                batch.column(1).to_pylist()):
                arr = np.array(words, np.int64).view(np.uint64)
                for s in seeds(arr, seed_plan([length_class(len(arr))])):
                    seed += _as_long(s)
                    win += [w] * len(s)
                    pos += range(len(s))
            yield pa.RecordBatch.from_arrays(
                [pa.array(seed, pa.int64()), pa.array(win, pa.int64()),
                 pa.array(pos, pa.int32())], ["seed", "window_id", "pos"])

    return windows.select("window_id", "words").mapInArrow(
        emit, "seed long, window_id long, pos int")


def _bitmap(seed_rows: DataFrame) -> np.ndarray:
    """BITMAP_BITS bits, two per seed, as 64-bit words."""
    low = BITMAP_BITS - 1
    bits = seed_rows.select(F.explode(F.expr(
        f"array(seed & {low}, shiftright(seed, {SECOND}) & {low})"))
        .alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(bit & 63))")).alias("bits")
    ).collect()
    out = np.zeros(BITMAP_BITS // 64, np.int64)
    for r in words:
        out[r.at] = r.bits
    return out.view(np.uint64)


def _marked(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    low = x & np.uint64(BITMAP_BITS - 1)
    return (table[low >> np.uint64(6)] >> (low & np.uint64(63))
            & np.uint64(1)).astype(bool)


def _hit_regions(words: np.ndarray, hits: dict[int, list[int]]
                 ) -> Iterator[tuple[int, np.ndarray, list]]:
    """Stretches of a document that hold its hits with WINDOW words around;
    a stretch ends where REGION_WORDS are reached or hits are far apart."""
    starts = sorted(hits)
    k = 0
    while k < len(starts):
        first, j = starts[k], k
        while (j + 1 < len(starts)
               and starts[j + 1] - starts[j] <= 2 * WINDOW
               and starts[j + 1] - first <= REGION_WORDS):
            j += 1
        lo = max(0, first - WINDOW)
        hi = min(len(words), starts[j] + WINDOW)
        yield lo, words[lo:hi], [(s, at - lo) for at in starts[k:j + 1]
                                 for s in hits[at]]
        k = j + 1


def _regions(docs: DataFrame, bits: np.ndarray, classes: list[int]
             ) -> DataFrame:
    bitmap = docs.sparkSession.sparkContext.broadcast(bits)
    plan = seed_plan(classes)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bitmap.value

        def flush(ids: list, parts: list[list[int]]) -> pa.RecordBatch:
            lens = np.array([len(p) for p in parts])
            ends = np.cumsum(lens)
            flat = np.fromiter((h for p in parts for h in p), np.uint64,
                               int(ends[-1]) if len(ends) else 0)
            found: dict[int, dict[int, list[int]]] = {}
            for mask, s in zip(plan, seeds(flat, plan)):
                hit = np.nonzero(_marked(table, s))[0]
                hit = hit[_marked(table, s[hit] >> np.uint64(SECOND))]
                doc = np.searchsorted(ends, hit, side="right")
                inside = hit + mask[-1] < ends[doc]
                for at, d, v in zip(hit[inside].tolist(),
                                    doc[inside].tolist(),
                                    _as_long(s[hit[inside]])):
                    found.setdefault(d, {}).setdefault(
                        at - int(ends[d] - lens[d]), []).append(v)
            rows = []
            for d, hits in sorted(found.items()):
                own = flat[ends[d] - lens[d]:ends[d]]
                for lo, part, marks in _hit_regions(own, hits):
                    rows.append((ids[d], lo, _as_long(part.copy()), [
                        {"seed": a, "at": b} for a, b in marks]))
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                 pa.array([r[3] for r in rows], pa.list_(pa.struct(
                     [("seed", pa.int64()), ("at", pa.int32())])))],
                ["doc_id", "region_start", "words", "hits"])

        ids, parts, n = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = word_hashes(text.as_py())
                ids.append(i)
                parts.append(words)
                n += len(words)
                if n >= CHUNK_WORDS:
                    yield flush(ids, parts)
                    ids, parts, n = [], [], 0
        if ids:
            yield flush(ids, parts)

    return doc_texts(docs).mapInArrow(
        find, "doc_id long, region_start int, words array<long>, "
              "hits array<struct<seed:long,at:int>>")


def best_stretch(equal: np.ndarray, share: float
                 ) -> tuple[int, int, int] | None:
    """(from, to, equal words) of the stretch with most equal words among
    those long enough with at least ``share`` (ties: shortest, first)."""
    n = len(equal)
    sums = np.concatenate(([0], np.cumsum(equal)))
    a, b = np.triu_indices(n + 1, min(n, STRETCH))
    same = sums[b] - sums[a]
    good = np.nonzero(same >= share * (b - a))[0]
    if not len(good):
        return None
    k = good[np.lexsort((a[good], (b - a)[good], -same[good]))[0]]
    return int(a[k]), int(b[k]), int(same[k])


def _verified(flags: DataFrame, share: float) -> DataFrame:
    """doc_id, item_id, item_start, doc_start, n_words, n_equal of each
    candidate's best stretch, from the equal places of whole windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, item, item_at, doc_at, equal in zip(
                    *[c.to_pylist() for c in batch.columns]):
                best = best_stretch(np.array(equal), share)
                if best:
                    a, b, same = best
                    rows.append((doc, item, item_at + a, doc_at + a, b - a,
                                 same))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(
                    [pa.int64()] * 2 + [pa.int32()] * 4)],
                ["doc_id", "item_id", "item_start", "doc_start", "n_words",
                 "n_equal"])

    return flags.select(
        "doc_id", "item_id", "item_start", "doc_start", "equal").mapInArrow(
        run, "doc_id long, item_id long, item_start int, doc_start int, "
             "n_words int, n_equal int")


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE
          ) -> DataFrame:
    """doc_id, item_id, item_start, doc_start, n_words, n_equal: for each
    document and item found in it, the best stretch (positions in words)."""
    windows = stored(benchmark_windows(benchmark), "seed-windows")
    seed_rows = stored(_window_seeds(windows), "seed-rows")
    classes = [r[0] for r in windows.select(F.least(
        F.floor(F.size("words") / 5) * 5, F.lit(STRETCH)).cast("int"))
        .distinct().collect()]  # at most as many as MASKS has
    regions = stored(
        _regions(docs, _bitmap(seed_rows), classes)
        .withColumn("region", F.monotonically_increasing_id()),
        "seed-regions")
    hits = regions.select("region", F.inline("hits"))
    aligned = (hits.join(seed_rows, "seed")
               .select("region", "window_id",
                       (F.col("at") - F.col("pos")).alias("shift"))
               .distinct())
    pairs = aligned.join(regions.select(
        "region", "doc_id", "region_start", "words"), "region").join(
        windows.withColumnRenamed("words", "window"), "window_id")
    # Position i of the window stands at i + shift of the region.
    equal = F.transform(
        F.sequence(F.lit(0), F.size("window") - 1),
        lambda i: ((i + F.col("shift") >= 0) & F.coalesce(
            F.get("words", i + F.col("shift")) == F.get("window", i),
            F.lit(False))).cast("int"))
    flags = pairs.select(
        "doc_id", "item_id", "item_start",
        (F.col("region_start") + F.col("shift")).alias("doc_start"),
        equal.alias("equal")
    ).filter(F.aggregate("equal", F.lit(0), lambda n, x: n + x)
             >= share * F.least(F.size("equal"), F.lit(STRETCH)))
    best = F.max(F.struct("n_equal", (-F.col("doc_start")).alias("d"),
                          (-F.col("item_start")).alias("i"), "n_words"))
    return _verified(flags, share).groupBy("doc_id", "item_id").agg(
        best.alias("b")).select(
        "doc_id", "item_id", (-F.col("b.i")).alias("item_start"),
        (-F.col("b.d")).alias("doc_start"), "b.n_words", "b.n_equal")


def decontaminate(docs: DataFrame, benchmark: DataFrame,
                  share: float = SHARE, by_row: bool = False) -> DataFrame:
    """The rows of ``docs`` in which no item leaks, with all columns; without
    ``by_row``, rows that share the id of a leaking one go too."""
    if by_row:
        return rows_of(docs, stored(leaks(keyed(docs), benchmark, share),
                                    "seed-leaks"), "left_anti")
    import uuid
    key = f"k_{uuid.uuid4().hex}"
    bad = stored(leaks(docs, benchmark, share), "seed-leaks").select(
        F.col("doc_id").alias(key)).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col(key)), "left_anti")
