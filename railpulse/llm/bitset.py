"""A set of fingerprints as bits of bounded size: it may let others through, never
keeps a member out."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

MOST_BITS = 1 << 27
BITS_EACH = 32
BUCKET = 1 << 15  # bits of Spark's bitmaps


def bit_set(fps: DataFrame, most: int = MOST_BITS) -> np.ndarray:
    """The low bits of the fingerprints ``fp``, ``most`` bits (a power of two) at most."""
    wanted = BITS_EACH * fps.count()
    n_bits = min(most, max(BUCKET, 1 << max(0, wanted - 1).bit_length()))
    place = F.col("fp").bitwiseAND(F.lit(n_bits - 1))
    buckets = fps.select(F.shiftright(place, 15).alias("bucket"), place.bitwiseAND(BUCKET - 1).alias("bit")) \
        .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros(n_bits // 8, dtype=np.uint8)
    for bucket, bits in buckets.collect():  # at most n_bits / BUCKET rows
        out[bucket * BUCKET // 8:(bucket + 1) * BUCKET // 8] = np.frombuffer(bytes(bits), dtype=np.uint8)
    return out


def hit(bits: np.ndarray, fps: np.ndarray) -> np.ndarray:
    place = fps & np.uint64(8 * len(bits) - 1)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
