"""Bitmaps of fixed size that keep rows out of a shuffle.

A set of slots (longs from 1) becomes bitmaps of 4 kB by Spark's bitmap
aggregates; they are broadcast as arrays of byte values (16 kB each), and rows whose slot is not set are dropped
where they are read.  No row of the set is lost; rows that share a slot with it
pass too, so callers still join or count exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_BITS = 1 << 23  # a set of keys: 1 MB of bits, 4 MB broadcast, whatever the input


def slot_of(bits: int, *cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(bits)) + 1


def _bitmaps(slots: DataFrame) -> DataFrame:
    """(_bucket, _bytes): the slots in the first column of ``slots``."""
    s = F.col(slots.columns[0])
    maps = (slots.groupBy(F.bitmap_bucket_number(s).alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(s)).alias("_bits")))
    # Spark reads no byte of a binary as a number but through hex text: done once a byte here, not once a row.
    return maps.select("_bucket", F.expr("transform(sequence(1, 4096), i -> cast(conv(hex(substring(_bits, i, 1)), 16, 10) as int))")
                       .alias("_bytes"))


def _bit(df: DataFrame, slot: Column, slots: DataFrame, how: str) -> tuple[DataFrame, Column]:
    """``df`` with the bitmaps joined on, and the bit of the row's ``slot`` (null where its bitmap is missing)."""
    at = F.bitmap_bit_position("_slot")
    byte = F.get("_bytes", F.floor(at / F.lit(8)).cast("int"))
    joined = (df.withColumn("_slot", slot).withColumn("_bucket", F.bitmap_bucket_number("_slot"))
              .join(F.broadcast(_bitmaps(slots)), "_bucket", how))
    return joined, F.getbit(byte, (at % 8).cast("int"))


def with_set_slots(df: DataFrame, slot: Column, slots: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``slot`` is in the first column of ``slots``."""
    joined, bit = _bit(df, slot, slots, "inner")
    return joined.where(bit == 1).select(*df.columns)


def likely_in(df: DataFrame, key: str, ids: DataFrame, bits: int = KEY_BITS) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be in the first column of ``ids`` (for joins that keep few keys).

    Follow it with an inner join on distinct ids: Spark moves a semi join below the filter, where it meets all rows.
    """
    return with_set_slots(df, slot_of(bits, key), _slots(ids, bits))


def surely_not_in(df: DataFrame, key: str, ids: DataFrame, bits: int = KEY_BITS) -> DataFrame:
    """The other rows of ``df``: those that ``likely_in`` drops, whose ``key`` is not in the first column of ``ids``."""
    joined, bit = _bit(df, slot_of(bits, key), _slots(ids, bits), "left")
    return joined.where(F.coalesce(bit, F.lit(0)) == 0).select(*df.columns)


def _slots(ids: DataFrame, bits: int) -> DataFrame:
    return ids.select(slot_of(bits, ids.columns[0]).alias("_slot")).distinct()
