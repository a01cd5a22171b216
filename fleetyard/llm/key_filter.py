"""Bounded filters of 64-bit keys, made in Spark and tested in tasks or joins.

A key that is not in the filter is surely none of the keys it was made of;
about one in BITS_A_KEY others passes. A filter has at most MOST_BITS bits:
with more keys than that allows, more others pass. Filters only save rows;
what passes is compared exactly afterwards.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_A_KEY, MOST_BITS = 16, 1 << 28
# Bits of one row of a filter (Spark's bitmap functions).
MAP_BITS = 1 << 15


def filter_bits(n: int) -> int:
    """Size of a filter of ``n`` keys, a power of two."""
    return min(MOST_BITS, 1 << max(15, (BITS_A_KEY * max(n, 1) - 1).bit_length()))


def bit_maps(keys: DataFrame, key: Column, bits: int) -> DataFrame:
    """(bucket, map): the bits of the keys, in rows of 4 KB; at most bits / MAP_BITS rows."""
    place = (key.bitwiseAND(F.lit(bits - 1)) + 1).alias("place")
    return (keys.select(place).select(F.bitmap_bucket_number("place").alias("bucket"), F.bitmap_bit_position("place").alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map")))


def key_filter(keys: DataFrame, key: Column, n: int) -> np.ndarray:
    """The filter of about ``n`` keys as bytes, for :func:`may_have`; at most MOST_BITS / 8 come to the driver."""
    bits = filter_bits(n)
    out = np.zeros((bits // MAP_BITS, MAP_BITS // 8), dtype=np.uint8)
    t = bit_maps(keys, key, bits).toArrow()
    for bucket, bitmap in zip(t["bucket"].to_pylist(), t["map"].to_pylist()):
        out[bucket - 1] = np.frombuffer(bitmap, dtype=np.uint8)
    return out.reshape(-1)


def may_have(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Mask of the keys (long) that the filter has."""
    at = keys.astype(np.int64) & (8 * len(bits) - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def with_bit(df: DataFrame, maps: DataFrame, key: Column, bits: int, name: str) -> DataFrame:
    """``df`` with boolean ``name``: whether the filter ``maps`` (broadcast) has the row's key."""
    place = key.bitwiseAND(F.lit(bits - 1))
    bucket, found = f"{name}_bucket", f"{name}_map"
    maps = F.broadcast(maps.select(F.col("bucket").alias(bucket), F.col("map").alias(found)))
    byte = F.conv(F.hex(F.substring(F.col(found), (F.shiftright(place, 3) % (MAP_BITS // 8) + 1).cast("int"), F.lit(1))), 16, 10)
    bit = byte.cast("int").bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) != 0
    joined = df.join(maps, F.shiftright(place, 15) + 1 == F.col(bucket), "left")
    return joined.withColumn(name, F.coalesce(bit, F.lit(False))).drop(bucket, found)
