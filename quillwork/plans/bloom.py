"""A set of 64-bit keys as a filter of fixed size, whatever the number of keys.

What the filter lets through is joined exactly afterwards: a fuller filter lets more through and loses nothing. It is
built by an aggregate over its words, so the driver receives at most BITS / 64 rows, and BITS / 8 bytes are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26


def _positions(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        h = keys.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    mask = np.uint64(BITS - 1)
    return h & mask, (h >> np.uint64(34)) & mask


class Bloom:
    """The words of the filter; sent to the workers by a broadcast variable."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words

    def holds(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for at in _positions(keys):
            out &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def bloom_of(keys: DataFrame) -> Bloom:
    """The filter of a DataFrame of one column of longs; nulls are left out."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(np.concatenate(_positions(b.column(0).drop_null().to_numpy(zero_copy_only=False))))
            if not len(at):
                continue
            slots = (at >> np.uint64(6)).astype(np.int64)
            first = np.concatenate([[0], np.flatnonzero(np.diff(slots)) + 1])
            bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
            yield pa.RecordBatch.from_arrays([pa.array(slots[first]), pa.array(bits.view(np.int64))], names=["slot", "bits"])

    found = keys.mapInArrow(mark, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(BITS // 64, np.uint64)
    words[found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return Bloom(words)
