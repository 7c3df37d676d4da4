"""Operator 7: packing by lexical retrieval.

Every document is tokenised (identifiers of a tokenizer file, then id 0).
Its whole windows of ``WINDOW`` ids are sequences of their own; the rest of
it, its tail, is packed with other tails.  Tails are dealt out by min-hashes
of their ids, the appended id 0 left out (ties by document and row, so that no
key is hot), into shards of ``SHARD`` tails.  Each shard has a BM25 inverted index over its tails, with
document frequencies and lengths of the whole corpus.  A seed tail opens a
window, its best unused neighbours fill it greedily, and where none fits
whole, the best one is cut to fit and its remainder stays in the index.  So
every window of a shard is full; the last tails of a task are cut to powers of
two, which need no padding either.

Tokenising: a text is cut at blanks and line feeds where exactly one stands
between two other characters; the tokenizer's pattern never joins across
these, so the ids of the pieces are those of the text.  The distinct pieces of
some MB of texts are looked up once, in a bounded table per worker; those it
lacks go to the library many at a time, joined by their separators, which only
start an identifier.  Texts with special strings or adjacent blanks are
tokenised whole.

Defined results: a null or empty text is the single id 0; null ids, repeated
rows and ties are packed row by row; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import (
    CACHED_LENGTH, at_work, doc_texts, give_back, stored)
from runledger.llm.sketches import CHUNK, summed_counts

VOCABULARY = "byte_bpe_50k.json"
WINDOW = 1024
SHARD = 2048
TASK_ROWS = 16_384          # tails per task, about
K1, B = 1.2, 0.75
NEIGHBOURS = 32             # ranked per seed; the first unused are always used
IDS = 1 << 16               # identifiers are below this
COMMON = 512                # ids of a shard whose postings are a matrix
AHEAD = 64                  # tails scored at once
ROUTE_HASHES = 4            # 16 bits each
CACHE_ENTRIES = 1 << 20
SLICE_BYTES = 8 << 20       # of texts whose pieces are looked up together
JOINED = 512                # new pieces in one call of the tokenizer

# A fixed permutation: the hash of every identifier.
_RANK = np.argsort([zlib.crc32(b"route %d" % i) for i in range(IDS)],
                   kind="stable").astype(np.uint16)

# White space, in Arrow's expressions; without the line feed in the second,
# which finds units that are tokenised by themselves.
_BLANK = ("[\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
          "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]")
_ODD = "\\A\\n?\\z|" + _BLANK.replace("\\t-\\r", "\\t\\x0b-\\r")
PIECES = ("doc_id long, start long, length long, ids_crc32 long, "
          "doc_tokens long, sequence_id long, offset long")


def _picked(flat: np.ndarray, start: np.ndarray, size: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``flat`` one after the other, and where each of them ends."""
    end = np.cumsum(size, dtype=np.int64)
    kind = np.int32 if max(len(flat), end[-1] if len(end) else 0) < 1 << 31 \
        else np.int64
    at = np.repeat((start - (end - size)).astype(kind), size)
    at += np.arange(len(at), dtype=kind)
    return flat[at], end


class Encoder:
    """Ids of texts as 16-bit little-endian numbers."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > IDS:
            raise ValueError("identifiers need more than 16 bits")
        special = [t.content for t in
                   self.tokenizer.get_added_tokens_decoder().values()]
        self.whole_only = "|".join([_BLANK + "{2}", *map(re.escape, special)])
        self.limit = cache_entries
        # Pieces with white space inside, after a line feed or none and after
        # a blank; all others are in the table below.
        self.first: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.line_feed = self.whole("\n")
        self.units = pa.array([], pa.string())
        self.flat = np.empty(0, "<u2")
        self.start = self.size = np.empty(0, np.int64)
        # Identifiers that a separator starts: no piece has one inside.
        signs = tuple(self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0]
                      for c in " \n")
        self.opens = np.zeros(IDS, bool)
        self.opens[[i for t, i in self.tokenizer.get_vocab().items()
                    if t.startswith(signs)]] = True

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}H", *ids)

    def _piece(self, piece: str, blank: str, cache: dict[str, bytes]
               ) -> bytes:
        ids = cache.get(piece)
        if ids is None:
            ids = self.whole(blank + piece)
            if len(cache) >= self.limit:
                cache.clear()
            if len(piece) <= CACHED_LENGTH:
                cache[piece] = ids
        return ids

    def _single(self, unit: str) -> np.ndarray:
        """Ids of one unit by itself."""
        if unit[:1] != "\n":
            ids = self._piece(unit, " ", self.spaced)
        else:
            ids = self.line_feed + (
                self._piece(unit[1:], "", self.first) if unit[1:] else b"")
        return np.frombuffer(ids, "<u2")

    def _joined(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units in a row by one call of the library, and how many
        each has."""
        units = units.to_pylist()
        text = (" " + " ".join(units)).replace(" \n", "\n")
        ids = np.array(self.tokenizer.encode_batch_fast(
            [text], add_special_tokens=False)[0].ids, "<u2")
        at = np.flatnonzero(self.opens[ids])
        if len(at) == len(units) and at[0] == 0:
            return ids, np.diff(at, append=len(ids))
        parts = [self._single(u) for u in units]     # can't be told apart
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def _looked_up(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray,
                                                   np.ndarray]:
        """All ids, and where those of each unit start and how many they are.
        A unit is a piece after a blank, or a line feed and the piece after
        it; those new to the table are tokenised and added."""
        known = pc.index_in(units, value_set=self.units).fill_null(
            -1).to_numpy()
        new = np.flatnonzero(known < 0)
        odd = pc.match_substring_regex(units.take(new), _ODD).to_numpy(
            zero_copy_only=False)
        plain, odd = new[~odd], new[odd]
        texts = units.take(plain)
        ids, sizes = [self.flat], [np.empty(0, np.int64)]
        for k in range(0, len(plain), JOINED):
            flat, size = self._joined(texts.slice(k, JOINED))
            ids.append(flat)
            sizes.append(size)
        for u in units.take(odd).to_pylist():
            ids.append(self._single(u))
            sizes.append(np.array([len(ids[-1])]))
        made = np.concatenate(sizes)
        size, start = np.empty((2, len(units)), np.int64)
        order = np.concatenate([plain, odd])
        size[order] = made
        start[order] = len(self.flat) + np.cumsum(made) - made
        old = np.flatnonzero(known >= 0)
        size[old], start[old] = self.size[known[old]], self.start[known[old]]
        flat = np.concatenate(ids)
        self._remember(units, plain, flat, start, size)
        return flat, start, size

    def _remember(self, units: pa.Array, plain: np.ndarray, flat: np.ndarray,
                  start: np.ndarray, size: np.ndarray) -> None:
        """Add the new units; a full table starts anew with those in use."""
        short = pc.less_equal(pc.binary_length(units), CACHED_LENGTH) \
            .to_numpy(zero_copy_only=False)
        rows, kept = plain[short[plain]], self.units
        if len(kept) + len(rows) > self.limit:
            rows, kept = np.flatnonzero(short)[:self.limit], kept.slice(0, 0)
            self.flat, self.start, self.size = (
                self.flat[:0], self.start[:0], self.size[:0])
        ids, end = _picked(flat, start[rows], size[rows])
        self.units = pa.concat_arrays([kept, units.take(rows)])
        self.start = np.concatenate(
            [self.start, len(self.flat) + end - size[rows]])
        self.size = np.concatenate([self.size, size[rows]])
        self.flat = np.concatenate([self.flat, ids])

    def _slice(self, texts: pa.Array) -> list[np.ndarray]:
        hard = pc.match_substring_regex(texts, self.whole_only)
        # A line feed before every text makes all pieces units.
        lists = pc.split_pattern(pc.binary_join_element_wise(
            "\n", pc.replace_substring(texts.filter(pc.invert(hard)), "\n",
                                       " \n"), ""), " ")
        named = lists.flatten().dictionary_encode()
        flat, start, size = self._looked_up(named.dictionary)
        unit = named.indices.to_numpy()
        flat, end = _picked(flat, start[unit], size[unit])
        bounds = np.append(0, end)[lists.offsets.to_numpy()
                                   - lists.offsets[0].as_py()].tolist()
        skip = len(self.line_feed) // 2
        plain = (flat[a + skip:b] for a, b in zip(bounds, bounds[1:]))
        return [np.frombuffer(self.whole(t.as_py()), "<u2") if h
                else next(plain) for t, h in zip(texts, hard.to_pylist())]

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text, ``SLICE_BYTES`` of them at a time or one text."""
        size = np.cumsum(pc.binary_length(texts).to_numpy(
            zero_copy_only=False).astype(np.int64))
        at, done = 0, 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(size, done + SLICE_BYTES,
                                                 "right")))
            yield from self._slice(texts.slice(at, to - at))
            give_back()
            at, done = to, int(size[to - 1])

    def encode(self, text: str) -> bytes:
        return next(self.encode_all(pa.array([text]))).tobytes()


_ENCODERS: dict[str, Encoder] = {}


def _encoder(vocabulary: str) -> Encoder:
    if vocabulary not in at_work(_ENCODERS):
        import public_tokenizers
        # Spark deals out the work; threads beside it only wait.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        path = vocabulary if "/" in vocabulary else \
            public_tokenizers.path(vocabulary)
        _ENCODERS[vocabulary] = Encoder(path)
    return _ENCODERS[vocabulary]


def ids_crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _route(ids: np.ndarray) -> int:
    """The ROUTE_HASHES smallest hashes of the set of ids, smallest first, as
    one number: tails that share ids come next to each other.  ``ids`` is a
    tail without the appended id, which all tails share."""
    low = np.unique(_RANK[ids])[:ROUTE_HASHES].tolist()
    low += [IDS - 1] * (ROUTE_HASHES - len(low))
    out = 0
    for x in low:
        out = out * IDS + x
    return out >> 1


def _tokenized(docs: DataFrame, vocabulary: str, window: int) -> DataFrame:
    """Whole windows, each a sequence (ids null), and tails (ids, route,
    row_no)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        part, made, row_no = TaskContext.get().partitionId() << 34, 0, 0
        for batch in batches:
            cols = [[] for _ in range(9)]
            for doc, ids in zip(batch.column(0).to_pylist(),
                                encoder.encode_all(batch.column(1))):
                ids = np.append(ids, np.uint16(0))
                n = len(ids)
                for at in range(0, n, window):
                    piece = ids[at:at + window]
                    if len(piece) == window:
                        row = (doc, at, window, ids_crc(piece), n,
                               2 * (part + made) + 1, None, None, None)
                        made += 1
                    else:
                        row = (doc, at, len(piece), None, n, None,
                               piece.tobytes(), _route(piece[:-1]),
                               part + row_no)
                        row_no += 1
                    for c, v in zip(cols, row):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (
                    *[pa.int64()] * 6, pa.binary(), pa.int64(),
                    pa.int64()))],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                 "sequence_id", "ids", "route", "row_no"])

    return doc_texts(docs).mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, "
             "doc_tokens long, sequence_id long, ids binary, route long, "
             "row_no long")


def _frequencies(tails: DataFrame) -> np.ndarray:
    """Number of tails that hold each id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(IDS, np.uint32)
        for batch in batches:
            for ids in batch.column(0):
                total[np.unique(np.frombuffer(ids.as_py(), "<u2"))] += 1
        part, chunks = TaskContext.get().partitionId(), range(IDS // CHUNK)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(chunks), pa.int32()),
             pa.array(chunks, pa.int32()),
             pa.array([total[c * CHUNK:(c + 1) * CHUNK].tobytes()
                       for c in chunks])], ["part", "chunk", "counts"])

    return summed_counts(tails.select("ids").mapInArrow(
        count, "part int, chunk int, counts binary"), IDS)


class ShardIndex:
    """BM25 inverted index over the tails of one shard.  The postings of its
    ``COMMON`` most frequent ids, nearly all that seeds meet, are a matrix,
    by which scores of ``AHEAD`` tails are computed at once."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray,
                 mean_length: float):
        sets, tf = [], []
        for t in tails:
            ids, n = np.unique(t, return_counts=True)
            sets.append(ids)
            tf.append(n)
        doc = np.repeat(np.arange(len(tails)), [len(s) for s in sets])
        term = np.concatenate(sets) if tails else np.empty(0, np.int64)
        freq = np.concatenate(tf) if tails else np.empty(0)
        length = np.array([len(t) for t in tails], float)[doc]
        weight = idf[term] * freq * (K1 + 1) / (
            freq + K1 * (1 - B + B * length / mean_length))
        top = np.argsort(-np.bincount(term, minlength=IDS), kind="stable")
        row = np.full(IDS, -1)
        row[top[:COMMON]] = np.arange(min(COMMON, IDS))
        common = row[term] >= 0
        self.matrix = np.zeros((COMMON, len(tails)))
        self.matrix[row[term[common]], doc[common]] = weight[common]
        self.common = [r[r >= 0] for r in (row[s] for s in sets)]
        self.rare = [s[row[s] < 0] for s in sets]
        doc, term, weight = doc[~common], term[~common], weight[~common]
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.ends = np.searchsorted(term[order], np.arange(IDS + 1))
        self.size = len(tails)
        self.ahead: dict[int, np.ndarray] = {}   # common part of some scores

    def scores(self, i: int, next_ones: np.ndarray | None = None
               ) -> np.ndarray:
        """BM25 of every tail of the shard for the ids of tail ``i``, which
        some of ``next_ones`` are asked for after it."""
        if i not in self.ahead:
            rows = [i, *(() if next_ones is None
                         else next_ones[:AHEAD - 1].tolist())]
            ids = np.zeros((len(rows), COMMON))
            for k, j in enumerate(rows):
                ids[k, self.common[j]] = 1
            self.ahead = dict(zip(rows, ids @ self.matrix))
        lo, hi = self.ends[self.rare[i]], self.ends[self.rare[i] + 1]
        n = hi - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.ahead[i] + np.bincount(self.doc[at], self.weight[at],
                                           self.size)


def pack_shard(tails: list[np.ndarray], idf: np.ndarray, mean_length: float,
               window: int) -> tuple[list[list[tuple[int, int, int]]],
                                     list[tuple[int, int, int]]]:
    """Full windows as lists of (tail, from, to), and the pieces left over
    (less than a window of ids in all)."""
    index = ShardIndex(tails, idf, mean_length)
    begin = [0] * len(tails)                   # ids of a tail placed so far
    unused = np.ones(len(tails), bool)
    left = sum(map(len, tails))
    windows, next_seed = [], 0
    while left >= window:
        while not unused[next_seed]:
            next_seed += 1
        i, room, pieces = next_seed, window, []

        def place(j: int, room: int, pieces=pieces) -> int:
            n = min(room, len(tails[j]) - begin[j])
            pieces.append((j, begin[j], begin[j] + n))
            begin[j] += n
            unused[j] = begin[j] < len(tails[j])
            return room - n

        room = place(i, room)
        if room:
            later = np.flatnonzero(unused[i + 1:]) + i + 1
            # Rounded, as equal tails are to have equal scores.
            score = np.where(unused, index.scores(i, later) + 1e-9,
                             0.0).astype(np.float32)
            if len(score) > NEIGHBOURS:
                best = np.argpartition(-score, NEIGHBOURS)[:NEIGHBOURS]
            else:
                best = np.arange(len(score))
            best = best[np.lexsort((best, -score[best]))].tolist()
            for j in best:                     # those that fit whole
                if room and unused[j] and len(tails[j]) - begin[j] <= room:
                    room = place(j, room)
            for j in best:                     # then the best, cut to fit
                if room and unused[j]:
                    room = place(j, room)
            j = next_seed
            while room:                        # neighbours are used up
                if unused[j]:
                    room = place(j, room)
                j += 1
        windows.append(pieces)
        left -= window
    rest = [(j, begin[j], len(tails[j])) for j in np.nonzero(unused)[0]]
    return windows, rest


def powers_of_two(rest: list[tuple[int, int, int]]
                  ) -> list[list[tuple[int, int, int]]]:
    """The pieces cut into sequences whose lengths are powers of two."""
    total = sum(b - a for _, a, b in rest)
    out, k = [], 0
    queue = list(rest)
    for bit in reversed(range(total.bit_length())):
        if not total >> bit & 1:
            continue
        room, pieces = 1 << bit, []
        while room:
            j, a, b = queue[k]
            n = min(room, b - a)
            pieces.append((j, a, a + n))
            room -= n
            if n == b - a:
                k += 1
            else:
                queue[k] = (j, a + n, b)
        out.append(pieces)
    return out


def _packed(tails: DataFrame, idf: np.ndarray, mean_length: float,
            window: int, shard: int) -> DataFrame:
    model = tails.sparkSession.sparkContext.broadcast(idf)   # IDS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId() << 34, 0
        rows: list[tuple] = []          # (doc, start, doc_tokens, ids)

        def emit(sequences) -> pa.RecordBatch:
            nonlocal made
            cols = [[] for _ in range(7)]
            for pieces in sequences:
                offset = 0
                for j, a, b in pieces:
                    doc, start, n, ids = rows[j]
                    for c, v in zip(cols, (
                            doc, start + a, b - a, ids_crc(ids[a:b]), n,
                            2 * (part + made), offset)):
                        c.append(v)
                    offset += b - a
                made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                 "sequence_id", "offset"])

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal rows
            windows, rest = pack_shard([r[3] for r in rows], model.value,
                                       mean_length, window)
            out = emit(windows + (powers_of_two(rest) if last else []))
            # What is left over opens the next shard of the task.
            rows = [(rows[j][0], rows[j][1] + a, rows[j][2], rows[j][3][a:b])
                    for j, a, b in rest]
            return out

        for batch in batches:
            for doc, start, n, ids in zip(*[batch.column(c).to_pylist()
                                            for c in range(4)]):
                rows.append((doc, start, n, np.frombuffer(ids, "<u2").astype(
                    np.int64)))
                if len(rows) >= shard:
                    yield flush(False)
        if rows:
            yield flush(True)

    return tails.select("doc_id", "start", "doc_tokens", "ids").mapInArrow(
        run, PIECES)


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, window: int = WINDOW,
         shard: int = SHARD, task_rows: int = TASK_ROWS) -> DataFrame:
    """One row per piece; see PIECES for the columns."""
    rows = stored(_tokenized(docs, vocabulary, window), "packing-tokens")
    tails = rows.filter("ids is not null")
    n, mean = tails.agg(F.count(F.lit(1)), F.avg("length")).first()
    whole = rows.filter("ids is null").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        "sequence_id", F.lit(0).cast("long").alias("offset"))
    if not n:
        return whole
    df = _frequencies(tails).astype(float)
    idf = np.log1p((n - df + 0.5) / (df + 0.5))
    key = ["route", "doc_id", "start", "row_no"]
    dealt = tails.repartitionByRange(-(-n // task_rows), *key) \
        .sortWithinPartitions(*key)
    packed = stored(_packed(dealt, idf, mean, window, shard),
                    "packing-pieces")
    return whole.unionByName(packed)
