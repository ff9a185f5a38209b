"""Telling rows of a few keys from all others without moving the rows.

A table of bits says of each key whether it may be listed. Rows whose bit is off are
surely not listed and stay where they are; only the others need to be shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentloom.session import settle

#: Bits in one bitmap, as Spark's bitmap functions lay them out.
BITMAP_BITS = 32_768
#: Bits per listed key, up to as many bitmaps as may be broadcast (4 KiB each).
BITS_PER_KEY = 16
MOST_BITMAPS = 2_048


def may_be_listed(df: DataFrame, key: str, listed: DataFrame, flag: str) -> DataFrame:
    """Add `flag`: true for each row whose bigint `key` is in `listed`, and for few others.

    `listed` has one column of bigint keys and is read twice. The broadcast is at most
    8 MiB; with very many keys more rows are flagged, never fewer.
    """
    (name,) = listed.columns
    keys = listed.count()
    bitmaps = min(max(-(-keys * BITS_PER_KEY // BITMAP_BITS), 1), MOST_BITMAPS)

    def position(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(bitmaps * BITMAP_BITS)) + 1

    place = position(name)
    bits = listed.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")
    )
    bits = settle(bits, "bits")  # at most MOST_BITMAPS rows of 4 KiB
    bit = F.bitmap_bit_position(position(key))
    byte = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
    on = F.getbit(byte.cast("int"), (bit % 8).cast("int")) == 1
    return (
        df.withColumn("_bucket", F.bitmap_bucket_number(position(key)))
        .join(F.broadcast(bits), "_bucket", "left")
        .withColumn(flag, F.coalesce(on, F.lit(False)))
        .drop("_bucket", "_bits")
    )
