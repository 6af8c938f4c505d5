"""A Bloom filter of fixed size, built by Spark and carried into tasks by value.

It only saves work: what it lets through is joined exactly, and what it stops
cannot be in the set.  Its size is fixed, however large the set: a set far
beyond it fills the filter, which then stops nothing, and the join does all.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 23  # 2^23 bits: 1 MB in the driver and in each task
PROBES = 3


def _slots(h: np.ndarray) -> np.ndarray:
    """Bit numbers of each hash, one row for each probe."""
    return np.stack([((h >> np.uint64(i * 20)) & np.uint64((1 << BITS) - 1)).astype(np.int64) for i in range(PROBES)])


def collect(hashes: DataFrame, column: str) -> np.ndarray:
    """Filter of all values of a long column: at most 2^17 rows of 64 bits reach the driver."""
    h = F.col(column)
    bits = hashes.where(h.isNotNull()).select(
        F.explode(F.array(*(F.shiftrightunsigned(h, i * 20).bitwiseAND((1 << BITS) - 1) for i in range(PROBES)))).alias("slot")
    )
    words = bits.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")
    )
    table = np.zeros(1 << (BITS - 6), np.uint64)
    for batch in words.toArrow().to_batches():
        table[batch.column(0).to_numpy()] = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
    return np.unpackbits(table.view(np.uint8), bitorder="little").view(bool)


def may_hold(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """False only for values that are not in the set.  `table` has one byte for each bit."""
    out = table[_slots(h)[0]]
    rest = np.flatnonzero(out)
    out[rest] = table[_slots(h[rest])].all(axis=0)
    return out


def packed(table: np.ndarray) -> bytes:
    return np.packbits(table, bitorder="little").tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little").view(bool)
