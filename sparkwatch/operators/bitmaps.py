"""Bitmaps of keys by hash: a set of any size told apart by 4 MB, with false hits but no misses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITMAP_BITS = 1 << 25  # 4 MB, the bound of a broadcast bitmap


def slot_of(key: str) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(BITMAP_BITS))


def bitmap_of(df: DataFrame, key: str) -> DataFrame:
    """(block, bits): a bitmap of the keys by hash, of bounded size whatever the data."""
    slots = df.select(slot_of(key).alias("slot"))
    return slots.groupBy(F.bitmap_bucket_number("slot").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )


def marked(df: DataFrame, key: str, bitmap: DataFrame) -> DataFrame:
    """``df`` with a column ``__hit``: false only if the key is not among those of the bitmap."""
    slotted = df.withColumn("__slot", slot_of(key)).withColumn("__block", F.bitmap_bucket_number("__slot"))
    named = F.broadcast(bitmap.select(F.col("block").alias("__block"), F.col("bits").alias("__bits")))
    place = F.bitmap_bit_position("__slot")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    hit = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    return slotted.join(named, "__block", "left").withColumn("__hit", hit).drop("__slot", "__block", "__bits")
