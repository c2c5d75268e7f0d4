"""Bitmaps of fixed size that tell a scan which rows a later join could need.

A key's hash picks a slot. However many keys there are, a bitmap has ``slots / 8``
bytes, so its broadcast has a proven bound; keys that share a slot only let through
rows that the join, which stays exact, drops again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap: 2 MB, however large the corpus.
SLOTS = 1 << 24


def _slot(columns: Sequence[str], slots: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(slots))


def bitmap(keys: DataFrame, columns: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """(_bucket, _bits) of the keys' slots."""
    return (
        keys.select(_slot(columns, slots).alias("_slot"))
        .groupBy(F.bitmap_bucket_number("_slot").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits"))
    )


def with_hit(
    df: DataFrame, columns: Sequence[str], bits: DataFrame, name: str, slots: int = SLOTS
) -> DataFrame:
    """Add ``name``: whether the slot of the row's key is set in the bitmap."""
    slot = _slot(columns, slots)
    position = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("_bits", position.cast("int") / 8 + 1, 1)), 16, 10)
    hit = F.getbit(byte.cast("int"), (position % 8).cast("int")) == 1
    return (
        df.withColumn("_bucket", F.bitmap_bucket_number(slot))
        .join(F.broadcast(bits), "_bucket", "left")
        .withColumn(name, F.coalesce(hit, F.lit(False)))
        .drop("_bucket", "_bits")
    )


def perhaps(
    rows: DataFrame, keys: DataFrame, columns: Sequence[str], slots: int = SLOTS
) -> DataFrame:
    """Rows whose key may be among ``keys``; the others go where they are read."""
    hit = with_hit(rows, columns, bitmap(keys, columns, slots), "_hit", slots)
    return hit.filter("_hit").drop("_hit")


def only(rows: DataFrame, keys: DataFrame, key: str, slots: int = SLOTS) -> DataFrame:
    """Rows whose key is among ``keys``."""
    return perhaps(rows, keys, [key], slots).join(keys.select(key), key, "left_semi")


def without(rows: DataFrame, keys: DataFrame, key: str, slots: int = SLOTS) -> DataFrame:
    """Rows whose key is not among ``keys``; most of them without a shuffle."""
    hit = with_hit(rows, [key], bitmap(keys, [key], slots), "_hit", slots)
    open_ = hit.filter("_hit").join(keys.select(key), key, "left_anti")
    return hit.filter("NOT _hit").unionByName(open_).drop("_hit").select(rows.columns)
