"""Fixed-size summaries that may be sent to every task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import stored

BITMAP_BITS = 1 << 26   # 8 MB
CHUNK = 1 << 14
FAN_IN = 64


def bitmap(values: Column, rows: DataFrame, bits: int = BITMAP_BITS
           ) -> np.ndarray:
    """A bitmap with the low bits of every value set.  Its size is fixed; a
    set larger than it only makes the test below pass more often."""
    low = values.bitwiseAND(F.lit(bits - 1))
    at = rows.select(F.shiftright(low, 6).alias("at"),
                     low.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    words = at.groupBy("at").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("word"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([b.column(0).to_numpy().tobytes()]),
                 pa.array([b.column(1).to_numpy().tobytes()])],
                ["at", "word"])

    out = np.zeros(bits // 64, np.int64)
    for r in words.mapInArrow(pack, "at binary, word binary").collect():
        out[np.frombuffer(r["at"], np.int64)] = np.frombuffer(
            r["word"], np.int64)
    return out.view(np.uint64)


def in_bitmap(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each value (int64 or uint64) may be in the set."""
    low = values.view(np.uint64) & np.uint64(len(table) * 64 - 1)
    return ((table[low >> np.uint64(6)] >> (low & np.uint64(63)))
            & np.uint64(1)).astype(bool)


def summed_counts(parts: DataFrame, size: int) -> np.ndarray:
    """Sum of count vectors given in chunks: (part int, chunk int, counts
    binary of CHUNK uint32).  At most FAN_IN parts meet in one group, level
    by level, so no group grows with the number of tasks."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(CHUNK, np.uint32)
        for c in pdf["counts"]:
            total += np.frombuffer(c, np.uint32)
        return pd.DataFrame({"part": [pdf["part"].iloc[0] // FAN_IN],
                             "chunk": [pdf["chunk"].iloc[0]],
                             "counts": [total.tobytes()]})

    rows, top = parts, None
    while top is None or top > 0:
        rows = stored(rows.groupBy(
            F.floor(F.col("part") / FAN_IN), "chunk").applyInPandas(
            add, "part int, chunk int, counts binary"), "count-sketch")
        top = rows.agg(F.max("part")).first()[0] or 0
    out = np.zeros(size, np.uint32)
    for r in rows.collect():   # ``size`` numbers in all
        at = r["chunk"] * CHUNK
        out[at:at + CHUNK] = np.frombuffer(r["counts"], np.uint32)
    return out
