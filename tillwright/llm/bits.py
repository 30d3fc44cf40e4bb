"""Bit tables of fixed size: superset tests that save shuffling and never decide a result.

A value picks one 64-bit word of the table and sets `PROBES` bits in it. A table is built by a grouped
aggregate and is at most `2 ** (bits - 6)` rows when it reaches the driver, however large the data.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROBES = 4


def table(values: DataFrame, column: str, bits: int) -> np.ndarray:
    """Table over a bigint column of well-mixed hashes; null values are left out."""
    if bits < 7:
        raise ValueError("a bit table has 7 bits of address at least")
    mask = " | ".join(f"shiftleft(1L, cast(shiftright(value, {6 * probe}) & 63L AS int))" for probe in range(PROBES))
    filled = (
        values.select(F.col(column).alias("value"))
        .where("value IS NOT NULL")
        .select(F.shiftrightunsigned("value", 70 - bits).alias("word"), F.expr(mask).alias("mask"))
        .groupBy("word")
        .agg(F.bit_or("mask").alias("mask"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[filled["word"].to_numpy()] = filled["mask"].to_numpy().view(np.uint64)
    return out


def inside(filled: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each 64-bit hash may have been put in."""
    bits = 5 + len(filled).bit_length()
    mask = np.zeros(len(values), np.uint64)
    for probe in range(PROBES):
        mask |= np.uint64(1) << ((values >> np.uint64(6 * probe)) & np.uint64(63))
    return filled[values >> np.uint64(70 - bits)] & mask == mask
