"""Sets of whole numbers as exact bitmaps, probed without a shuffle of the probing rows.

A set becomes one row per 32,768 consecutive numbers that hold a member: the
bucket number and 4,096 bytes with a bit per number.  Form numbers are dense, so
a set of a quarter of a billion of them takes 32 MB and still fits a broadcast
where its keys (some 40 bytes each there) do not.  Sparse numbers can take 4 KB
each: ``bitmap_bytes`` counts the buckets first, so that the bitmaps are built
only where all of them together fit the planner's broadcast limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITMAP_BYTES = 4096
ROW_BYTES = BITMAP_BYTES + 64       # with the row's header and its entry in the hash table


def key_bitmaps(keys: DataFrame, key: str) -> DataFrame:
    """``bit_bucket``, ``bits``: the non-NULL numbers of ``keys``, merged on the map side."""
    number = F.col(key).cast("long")
    return (keys.where(number.isNotNull())
            .groupBy(F.bitmap_bucket_number(number).alias("bit_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")))


def bitmap_bytes(keys: DataFrame, key: str) -> int:
    """Bytes of ``key_bitmaps(keys, key)`` in a broadcast, before they are built."""
    number = F.col(key).cast("long")
    return ROW_BYTES * keys.where(number.isNotNull()).select(F.bitmap_bucket_number(number)).distinct().count()


def probed(df: DataFrame, key: Column, bitmaps: DataFrame, member: bool) -> DataFrame:
    """Rows of ``df`` whose key is (``member``) or is not in the set; a NULL key is in no set."""
    number = key.cast("long")
    place = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substr(F.col("bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    masked = F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(F.lit(1))
    joined = df.join(bitmaps, F.bitmap_bucket_number(number) == F.col("bit_bucket"), "inner" if member else "left")
    kept = joined.where(masked == 1) if member else joined.where(F.coalesce(masked, F.lit(0)) == 0)
    return kept.drop("bit_bucket", "bits")
