"""Operator 9: token counts by heap-and-linked-list byte-pair merging.

The number of tokens of a word is its number of initial symbols less the
number of merges.  The symbols of a word form a linked list; a heap yields
the adjacent pair of lowest rank (leftmost on ties) until no pair has a rank.
No token identifiers are made.  Normalising and cutting a text into words is
left to the tokenizer file's own rules.

A text is cut at blanks and line feeds first, which no rule of the file joins
across; the counts of pieces are kept in a bounded cache per worker (cleared
when full), so each repeated word is merged once.  A special string of the
file inside a text counts as one token, as the library has it by default.

Defined results: a null or empty text has 0 bytes and 0 tokens; null ids,
repeated rows and extra columns pass through row by row; an empty table gives
an empty result.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import doc_texts

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
CACHE_ENTRIES = 400_000


def merge_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Number of merges that byte-pair encoding makes in a word."""
    n = len(symbols)
    syms = list(symbols)
    after = list(range(1, n + 1))      # n: end of the list
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get((syms[i], syms[i + 1]))
        if rank is not None:
            heap.append((rank, i, syms[i], syms[i + 1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if j >= n or syms[i] != left or syms[j] != right:
            continue                   # one of the pair has been merged
        merges += 1
        syms[i] = left + right
        syms[j] = ""                   # leaves the list
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            rank = ranks.get((syms[i], syms[k]))
            if rank is not None:
                heapq.heappush(heap, (rank, i, syms[i], syms[k]))
        h = before[i]
        if h >= 0:
            rank = ranks.get((syms[h], syms[i]))
            if rank is not None:
                heapq.heappush(heap, (rank, h, syms[h], syms[i]))
    return merges


class Counter:
    """Counts tokens of texts by one tokenizer file."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.tokenizer = Tokenizer.from_file(path)
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ranks: dict[tuple[str, str], int] = {}
        for i, m in enumerate(model["merges"]):
            pair = tuple(m.split(" ")) if isinstance(m, str) else tuple(m)
            self.ranks.setdefault(pair, i)
        special = sorted((t["content"] for t in spec["added_tokens"]),
                         key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) \
            if special else None
        self.limit = cache_entries
        self.pieces: dict[str, int] = {}
        self.words: dict[str, int] = {}

    def word(self, word: str) -> int:
        symbols = list(word)
        symbols[-1] += self.suffix
        return len(symbols) - merge_count(symbols, self.ranks)

    def piece(self, piece: str) -> int:
        text = self.tokenizer.normalizer.normalize_str(piece)
        total = 0
        for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text):
            n = self.words.get(word)
            if n is None:
                if len(self.words) >= self.limit:
                    self.words.clear()
                n = self.word(word)
                if len(word) <= 64:    # bounds the cache's bytes
                    self.words[word] = n
            total += n
        return total

    def plain(self, text: str) -> int:
        pieces, total = self.pieces, 0
        for piece in text.replace("\n", " ").split(" "):
            n = pieces.get(piece)
            if n is None:
                n = self.piece(piece) if piece else 0
                if len(pieces) >= self.limit:
                    pieces.clear()
                if len(piece) <= 64:
                    pieces[piece] = n
            total += n
        return total

    def count(self, text: str) -> int:
        if self.special is None or "<|" not in text:
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))


_COUNTERS: dict[tuple, Counter] = {}


def _counter(vocabulary: str) -> Counter:
    """One counter per worker process and file."""
    if vocabulary not in _COUNTERS:
        import public_tokenizers
        path = vocabulary if "/" in vocabulary else \
            public_tokenizers.path(vocabulary)
        _COUNTERS[vocabulary] = Counter(path)
    return _COUNTERS[vocabulary]


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY,
                 limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row.  ``vocabulary``
    is a name that ``public_tokenizers`` knows, or a path on the workers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            n = [counter.count(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    rows = doc_texts(docs).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
        "text")
    return rows.mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
