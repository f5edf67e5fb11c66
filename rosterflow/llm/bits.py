"""Bit arrays over 64-bit hashes: what was put in is always found, of the rest a bounded share is too."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for each hash, and of the largest array: 16 MB, whatever it is put over.
BITS_EACH, MOST_BITS = 16, 1 << 27


def bit_array(hashes: DataFrame) -> np.ndarray:
    """Array over the column ``hash``. It is put together by Spark; the driver gets its words that are not zero."""
    bits = min(MOST_BITS, 1 << max(12, (BITS_EACH * hashes.count()).bit_length()))
    at = F.col("hash").bitwiseAND(F.lit(bits - 1))
    words = hashes.select(F.shiftright(at, 6).alias("word"), F.expr("shiftleft(1L, cast(hash & 63 as int))").alias("bit"))
    words = words.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bit").to_numpy()
    return out.view(np.uint64)


def contains(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(64 * len(bits) - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
