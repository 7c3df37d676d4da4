"""Operator 4: removal of repeated byte strings by names of sampled suffixes.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts
anywhere else, in any document.  Ordering every suffix of the corpus carries
some 24 bytes per byte of text through every pass; here only sampled suffixes
are carried, and only as long as a longer and longer prefix of theirs repeats:

1. Every string of LENGTH bytes (a window) picks the ``GRAM``-byte gram of
   least hash within it; the places picked are the sample, about one byte in a
   hundred.  The choice looks at the window alone, so equal windows pick the
   same place.  Grams are counted; a sample whose gram is alone is dropped.
2. The windows of a remaining sample place are cut into classes of up to
   ``STEP`` neighbouring starts.  All windows of a class share a core of
   ``LENGTH - STEP + 1`` bytes, and together they cover a span.  Cores are
   counted; a class whose core is alone is dropped.  If all spans around a
   core are equal, all of their windows repeat.
3. Around the other cores, spans are named and counted; the windows of a
   repeated span repeat.
4. Each window of the distinct spans that are left is named by its bytes and
   counted, which settles the rest.

So the sort by ever longer common prefixes is done by Spark's own shuffles,
whose sorts spill to disk; all counts combine before the shuffle, so no string
is hot, however often it occurs.  Grams and cores go by 64-bit names, where a
clash only lets a candidate live longer; spans and windows, which decide, by
128 bits.  Between the steps, bitmaps of fixed size tell the tasks what is
left; they may pass too much, which the counts then settle.

Defined results: null and empty texts have 0 bytes and lose none; matches never
cross documents; repeated rows repeat each other; null ids take part; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import doc_texts, stored
from runledger.llm.sketches import bitmap, in_bitmap

LENGTH, GRAM, STEP = 200, 32, 42
BLOCK = 1 << 19             # window starts handled at a time
CODEC = "zstd"              # of the tables between the steps
_BITS = 20                  # place of a gram within a block, low bits
_PLACE = np.uint64((1 << _BITS) - 1)

_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) \
    + np.uint64(1)
_BASE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_TOP = 1 << _BITS


def _powers(base: np.uint64) -> np.ndarray:
    out = np.full(_TOP + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: list[np.ndarray] = []


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefixes:
    """Names of the substrings of a byte block in constant time each."""

    def __init__(self, data: np.ndarray, names: int = 1):
        if not _POWERS:
            _POWERS.extend(_powers(b) for b in _BASE)
        self.sums = []
        for k in range(names):
            s = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_BYTE[k][data] * _POWERS[k][:len(data)], out=s[1:])
            self.sums.append(s)

    def name(self, at: np.ndarray, length, which: int = 0) -> np.ndarray:
        s = self.sums[which]
        return _mix((s[at + length] - s[at]) * _POWERS[which][_TOP - at])


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbouring values."""
    n = len(h)
    padded = np.full(-(-n // width) * width, ~np.uint64(0))
    padded[:n] = h
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def samples(names: Prefixes, size: int, inside: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first window, last window) of each sample place.  ``inside``
    tells for each window start whether the window lies in one document."""
    starts = np.arange(size - GRAM + 1)
    h = names.name(starts, GRAM)
    # Of equal hashes the leftmost is taken, as the place breaks the tie.
    key = (h & ~_PLACE) | starts.astype(np.uint64)
    place = (_least(key, LENGTH - GRAM + 1) & _PLACE).astype(np.int64)
    window = np.nonzero(inside)[0]
    place = place[window]
    if not len(window):
        none = np.empty(0, np.int64)
        return none, none, none
    new = np.r_[True, (place[1:] != place[:-1])
                | (window[1:] != window[:-1] + 1)]
    first = np.nonzero(new)[0]
    last = np.r_[first[1:], len(window)] - 1
    return place[first], window[first], window[last]


def blocks(ids: list[int], texts: list[bytes]
           ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Byte blocks of one or many documents: bytes, which window starts lie
    inside a document, and per byte the document and its first byte there.
    A long document is cut into blocks that overlap by a window."""
    parts, n = [], 0

    def join():
        data = np.concatenate([np.frombuffer(t, np.uint8) for _, t, _ in parts])
        size = np.array([len(t) for _, t, _ in parts])
        end = np.repeat(np.cumsum(size), size)
        at = np.arange(len(data))
        own = max(0, len(data) - LENGTH + 1)
        doc = np.repeat(np.array([d for d, _, _ in parts]), size)
        # Byte 0 of the block is byte ``shift`` of its document.
        shift = np.repeat(np.array([s for _, _, s in parts])
                          - (np.cumsum(size) - size), size)
        return data, (at + LENGTH <= end)[:own], doc, shift

    for doc, text in zip(ids, texts):
        if len(text) < LENGTH:
            continue
        for at in range(0, len(text) - LENGTH + 1, BLOCK):
            part = text[at:at + BLOCK + LENGTH - 1]
            if n and n + len(part) > BLOCK + LENGTH:
                yield join()
                parts, n = [], 0
            parts.append((doc, part, at))
            n += len(part)
    if n:
        yield join()


def _rows(docs: DataFrame) -> DataFrame:
    return doc_texts(docs).select(
        F.monotonically_increasing_id().alias("row_no"), "doc_id", "text")


def _encoded(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [t.as_buffer().to_pybytes() for t in batch.column(column)]


def _live_grams(rows: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, inside, _, _ in blocks(
                    batch.column(0).to_pylist(), _encoded(batch, 1)):
                names = Prefixes(data)
                place, _, _ = samples(names, len(data), inside)
                yield pa.RecordBatch.from_arrays([pa.array(
                    names.name(place, GRAM).view(np.int64))], ["gram"])

    grams = rows.select("row_no", "text").mapInArrow(run, "gram long")
    live = stored(grams.groupBy("gram").count().filter("count > 1")
                  .select("gram"), "suffix-grams")
    return bitmap(F.col("gram"), live)


def classes_of(names: Prefixes, place: np.ndarray, first: np.ndarray,
               last: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """For each class of offsets: the samples in it, first and last window of
    the class, and the name of its core."""
    for c in range(-(-(LENGTH - GRAM + 1) // STEP)):
        least, most = c * STEP, (c + 1) * STEP - 1
        a = np.maximum(first, place - most)
        z = np.minimum(last, place - least)
        which = np.nonzero(a <= z)[0]
        if len(which):
            core = names.name(place[which] - least, LENGTH - STEP + 1
                              ) if most <= LENGTH - GRAM else names.name(
                place[which] - least, least + GRAM)
            yield which, a[which], z[which], _mix(core + np.uint64(c))


def _classes(rows: DataFrame, grams: np.ndarray) -> DataFrame:
    """core, span (128 bits), row_no, at, n: the classes of live samples."""
    live = rows.sparkSession.sparkContext.broadcast(grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, inside, doc, shift in blocks(
                    batch.column(0).to_pylist(), _encoded(batch, 1)):
                names = Prefixes(data, 2)
                place, first, last = samples(names, len(data), inside)
                ok = in_bitmap(live.value, names.name(place, GRAM))
                place, first, last = place[ok], first[ok], last[ok]
                for which, a, z, core in classes_of(names, place, first,
                                                    last):
                    p = place[which]
                    # The span with the place of its windows within it.
                    salt = _mix(((z - a) * 1024 + (p - a)).astype(np.uint64))
                    size = z - a + LENGTH
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(core.view(np.int64)),
                         pa.array((names.name(a, size, 0) ^ salt)
                                  .view(np.int64)),
                         pa.array((names.name(a, size, 1) ^ salt)
                                  .view(np.int64)),
                         pa.array(doc[a]), pa.array(a + shift[a]),
                         pa.array((z - a + 1).astype(np.int32))],
                        ["core", "span", "span2", "row_no", "at", "n"])

    return stored(rows.select("row_no", "text").mapInArrow(
        run, "core long, span long, span2 long, row_no long, at long, n int"),
        "suffix-classes", CODEC)


def _texts_of(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """(row_no, doc_id, text) of the rows, and of some more."""
    # Row numbers count up in every partition, so they are hashed.
    some = rows.sparkSession.sparkContext.broadcast(
        bitmap(F.xxhash64("row_no"), numbers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = in_bitmap(some.value, batch.column(3).to_numpy())
            kept = batch.filter(pa.array(ok))
            yield pa.RecordBatch.from_arrays(kept.columns[:3],
                                             ["row_no", "doc_id", "text"])

    return rows.withColumn("mark", F.xxhash64("row_no")).mapInArrow(
        run, "row_no long, doc_id long, text string")


def _windows(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """name, name2, row_no, at of every window of the spans."""
    wanted = spans.groupBy("row_no").agg(
        F.sort_array(F.collect_list(F.struct("at", "n"))).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _encoded(batch, 1)
            for row, text, parts in zip(batch.column(0).to_pylist(), texts,
                                        batch.column(2).to_pylist()):
                data = np.frombuffer(text, np.uint8)
                out = ([], [], [])
                for p in parts:
                    part = data[p["at"]:p["at"] + p["n"] + LENGTH - 1]
                    names = Prefixes(part, 2)
                    at = np.arange(p["n"])
                    out[0].append(names.name(at, LENGTH, 0))
                    out[1].append(names.name(at, LENGTH, 1))
                    out[2].append(at + p["at"])
                cols = [np.concatenate(c) for c in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0].view(np.int64)),
                     pa.array(cols[1].view(np.int64)),
                     pa.array(np.full(len(cols[2]), row)),
                     pa.array(cols[2])], ["name", "name2", "row_no", "at"])

    return texts.select("row_no", "text").join(wanted, "row_no").mapInArrow(
        run, "name long, name2 long, row_no long, at long")


def _covered(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row_no, at, n): n neighbouring windows that repeat; and the texts of
    all rows that may have some."""
    classes = _classes(rows, _live_grams(rows))
    cores = stored(classes.groupBy("core").agg(
        F.count(F.lit(1)).alias("times"), F.min("span").alias("low"),
        F.max("span").alias("high")).filter("times > 1").select(
        "core", (F.col("low") != F.col("high")).alias("mixed")),
        "suffix-cores")
    left = stored(classes.join(cores, "core").drop("core"), "suffix-left", CODEC)
    texts = stored(_texts_of(rows, left.select("row_no")), "suffix-texts",
                   CODEC)
    whole = left.filter("not mixed").select("row_no", "at", "n")

    mixed = left.filter("mixed")
    # One row for each distinct span, with one of its places.
    spans = stored(mixed.groupBy("span", "span2").agg(
        F.count(F.lit(1)).alias("times"),
        F.min(F.struct("row_no", "at", "n")).alias("one")), "suffix-spans", CODEC)
    again = mixed.join(spans.filter("times > 1").select("span", "span2"),
                       ["span", "span2"]).select("row_no", "at", "n")
    windows = stored(_windows(texts, spans.select("one.*")),
                     "suffix-windows", CODEC)
    repeats = stored(windows.groupBy("name", "name2").count().filter(
        "count > 1").select("name", "name2"), "suffix-repeats")
    single = windows.join(repeats, ["name", "name2"]).select(
        "row_no", "at", F.lit(1).alias("n"))
    return whole.unionByName(again).unionByName(single), texts


def kept_bytes(text: bytes, covered: list[tuple[int, int]]
               ) -> tuple[bytes, int, int]:
    """What is left of a text, bytes removed, and maximal removed runs."""
    keep, removed, runs, at = [], 0, 0, 0
    end = -1
    for start, n in sorted(covered):
        stop = start + n - 1 + LENGTH
        if start > end:
            runs += 1
            keep.append(text[at:start])
            removed += stop - start
        elif stop > end:
            removed += stop - end
        end = max(end, stop)
        at = end
    keep.append(text[at:])
    return b"".join(keep), removed, runs


def remove_repeats(docs: DataFrame, file_scan: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept text
    (bytes, null where nothing is removed) of every row.

    The rows are numbered, and read several times.  A plain scan of files
    (``file_scan``) numbers them alike each time; any other input, such as
    the result of a shuffle, is stored once with its numbers."""
    rows = _rows(docs) if file_scan else stored(_rows(docs), "suffix-rows")
    covered, texts = _covered(rows)
    runs = stored(covered.groupBy("row_no").agg(F.collect_list(
        F.struct("at", "n")).alias("covered")), "suffix-covered", CODEC)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, parts in zip(_encoded(batch, 2),
                                   batch.column(3).to_pylist()):
                kept, removed, n = kept_bytes(
                    text, [(p["at"], p["n"]) for p in parts])
                out.append((len(text), removed, n,
                            hashlib.sha256(kept).hexdigest(), kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 *[pa.array([o[k] for o in out], pa.int64())
                   for k in range(3)],
                 pa.array([o[3] for o in out], pa.string()),
                 pa.array([o[4] for o in out], pa.binary())],
                ["row_no", "doc_id", "n_bytes", "n_removed", "n_spans",
                 "kept_sha256", "kept"])

    changed = stored(texts.select("row_no", "doc_id", "text").join(
        runs, "row_no").mapInArrow(
        cut, "row_no long, doc_id long, n_bytes long, n_removed long, "
             "n_spans long, kept_sha256 string, kept binary"),
        "suffix-changed", CODEC)
    data = F.encode("text", "UTF-8")
    zero = F.lit(0).cast("long")
    # The texts of changed rows stay where they are: only names are joined.
    same = rows.select(
        "row_no", "doc_id", F.length(data).cast("long").alias("n_bytes"),
        zero.alias("n_removed"), zero.alias("n_spans"),
        F.sha2(data, 256).alias("kept_sha256"),
        F.lit(None).cast("binary").alias("kept"))
    return same.join(changed.select("row_no"), "row_no", "left_anti") \
        .unionByName(changed).drop("row_no")
