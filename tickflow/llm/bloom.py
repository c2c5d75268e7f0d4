"""Bloom filters of bounded size: built by Spark from 64-bit keys, read in Arrow tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_U = np.uint64


class Bloom:
    """Keys in a filter of at most 16 MB (2 bits a key); built by Spark, read in tasks."""

    LEAST, MOST = 1 << 20, 1 << 27

    def __init__(self, keys: DataFrame) -> None:
        """``keys``: a written table with a column ``key``."""
        self.slots = min(max(1 << (16 * keys.count()).bit_length(), self.LEAST), self.MOST)
        halves = (F.col("key"), F.shiftrightunsigned("key", 32))
        both = F.array(*[x.bitwiseAND(F.lit(self.slots - 1)) + 1 for x in halves])  # from one on
        slot = keys.select(F.explode(both).alias("slot"))
        blocks = slot.groupBy(F.bitmap_bucket_number("slot").alias("block")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
        )
        table = np.zeros(self.slots // 8, dtype=np.uint8)
        for r in blocks.toLocalIterator():
            table[(r.block - 1) * 4096 : r.block * 4096] = np.frombuffer(r.bits, dtype=np.uint8)
        self.table = keys.sparkSession.sparkContext.broadcast(table)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        table, out = self.table.value, np.ones(len(keys), dtype=bool)
        for slot in (keys, keys >> _U(32)):
            slot = (slot & _U(self.slots - 1)).astype(np.int64)
            out &= (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
        return out

    def __getstate__(self) -> dict:
        return {"slots": self.slots, "table": self.table}
