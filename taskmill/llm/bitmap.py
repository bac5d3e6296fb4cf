"""A bitmap of fixed size that tells which 64-bit keys another table has.

It only drops keys that are surely absent: a table too large for it fills it and
drops less, nothing else changes. It is built by a distributed OR, so at most
2 ** (BITS - 6) rows of two numbers reach the driver, however large the table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 26
SLOTS = "slot int, bits bigint"

_MIX = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * _MIX
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _bit(keys: np.ndarray) -> np.ndarray:
    return (mix(keys) >> np.uint64(64 - BITS)).astype(np.int64)


class Seen:
    """The keys of one task."""

    def __init__(self) -> None:
        self.slots = np.zeros(1 << (BITS - 6), np.uint64)

    def add(self, keys: np.ndarray) -> None:
        at = _bit(keys)
        np.bitwise_or.at(self.slots, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))

    def rows(self) -> pa.RecordBatch:
        slot = np.flatnonzero(self.slots)
        return pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(self.slots[slot].view(np.int64))], ["slot", "bits"])


def assembled(slots: DataFrame) -> np.ndarray:
    """The bitmap of (slot, bits) rows of all tasks."""
    got = slots.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[got.column("slot").to_numpy()] = got.column("bits").to_numpy().astype(np.int64).view(np.uint64)
    return out


def has(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = _bit(keys)
    return (bitmap[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
