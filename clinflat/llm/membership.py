"""Sets of 64-bit hashes as bitmaps of bounded size, for use in tasks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 27  # 16 MB, the largest bitmap that tasks are sent
BUCKET = 1 << 15  # bits of one bitmap of Spark's bitmap functions


def bitmap_of(hashes: DataFrame) -> Callable[[], np.ndarray]:
    """The hashes (column ``h``) as a bitmap in every task.

    Spark's bitmap aggregates make it, in buckets of 4 KB; the driver lays out at most
    MOST_BITS, whatever the number of hashes. A hash may be found that is not there.
    """
    n, bits = hashes.count(), BUCKET
    while bits < min(16 * n, MOST_BITS):
        bits *= 2
    place = F.col("h").bitwiseAND(F.lit(bits - 1)) + 1  # the functions count from 1
    buckets = (
        hashes.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap"))
    )
    whole = np.zeros(bits // 8, np.uint8)
    for row in buckets.toLocalIterator():
        s = (row["bucket"] - 1) * (BUCKET // 8)
        whole[s : s + BUCKET // 8] = np.frombuffer(row["bitmap"], np.uint8)
    sent = hashes.sparkSession.sparkContext.broadcast(whole)
    return lambda: sent.value


def is_member(h: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    at = (h & np.uint64(len(bitmap) * 8 - 1)).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
