"""A sieve of keys: one bit per slot of a hash, for a map-side test whether a key may be among others.

It has ``SLOTS`` bits (1 MB) at any size of the table, in rows of 4 KB, and is broadcast. A key that is there is always
found; one that is not may be found too, the more often the fuller the sieve is, so what it lets through is decided exactly afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 23


def _slot(*key: Column) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(SLOTS)) + 1


def sieve(rows: DataFrame, *key: str, least: int = 2) -> DataFrame:
    """bucket, bits: the slots that at least so many rows fall into. At most ``SLOTS`` bits, in rows of 4 KB."""
    slots = rows.groupBy(_slot(*map(F.col, key)).alias("slot")).agg(F.count("*").alias("rows")).where(F.col("rows") >= least)
    return slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))


def shared(rows: DataFrame, found: DataFrame, name: str, *key: str) -> DataFrame:
    """Add ``name``: whether the row's key may stand in another row too (never wrongly false)."""
    slot = _slot(*map(F.col, key))
    at = F.bitmap_bit_position(slot)
    looked = rows.withColumn(f"{name}_bucket", F.bitmap_bucket_number(slot)).withColumn(f"{name}_at", at)
    bits = found.select(F.col("bucket").alias(f"{name}_bucket"), F.col("bits").alias(f"{name}_bits"))
    met = looked.join(F.broadcast(bits), f"{name}_bucket", "left")  # at most SLOTS bits
    byte = F.conv(F.hex(F.substr(F.col(f"{name}_bits"), (F.col(f"{name}_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.bit_get(byte, (F.col(f"{name}_at") % 8).cast("int")) == 1
    return met.withColumn(name, F.coalesce(is_set, F.lit(False))).drop(f"{name}_bucket", f"{name}_at", f"{name}_bits")
