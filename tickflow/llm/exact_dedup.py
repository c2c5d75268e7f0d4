"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

Each pass looks only at what the last one left open. Which lengths (then which
lengths with prefix hashes) occur twice is handed to the next scan as a bitmap of
fixed size, so no text is shuffled. A slot shared by two keys only lets a row through
to the next, finer pass; the last one compares length, prefix hash and SHA-256.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.slots import SLOTS, bitmap, with_hit
from tickflow.llm.text import or_empty
from tickflow.session import materialize


def _repeated(keys: DataFrame, columns: Sequence[str], slots: int) -> DataFrame:
    """A bitmap of the keys that occur more than once."""
    return bitmap(keys.groupBy(*columns).count().filter("count > 1"), columns, slots)


def exact_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: dict[str, Column] | None = None,
    prefix_chars: int = 256,
    slots: int = SLOTS,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, _digest, and ``carry``.

    ``_digest`` is the text's SHA-256 where the text was read in full, else null.

    Of rows with equal texts the one with the largest id stays. A null text equals the
    empty text. Null ids rank below all others; a group of null ids keeps them. Rows
    that repeat an id together with its text count in ``group_size`` and share their
    verdict. An empty table gives an empty result; other columns of ``docs`` are not
    read, so their names don't matter.
    """
    carry = carry or {}
    names = list(carry)
    rows = docs.select(
        F.col(id_col).alias("_id"),
        or_empty(text_col).alias("_text"),
        *[c.alias(name) for name, c in carry.items()],
    ).withColumn("_len", F.octet_length("_text"))
    lengths = _repeated(rows.select("_len"), ["_len"], slots)
    prefix = F.xxhash64(F.substring("_text", 1, prefix_chars))
    by_length = with_hit(rows, ["_len"], lengths, "_same_len", slots).withColumn(
        "_prefix", F.when(F.col("_same_len"), prefix)
    )
    heads = _repeated(
        by_length.filter("_same_len").select("_len", "_prefix"), ["_len", "_prefix"], slots
    )
    by_prefix = with_hit(by_length, ["_len", "_prefix"], heads, "_same_head", slots)
    digest = F.when(F.col("_same_len") & F.col("_same_head"), F.sha2("_text", 256))
    narrow = materialize(
        by_prefix.select("_id", "_len", "_prefix", digest.alias("_digest"), *names), "exact"
    )
    single = narrow.filter("_digest is null").select(
        F.col("_id").alias("doc_id"),
        F.col("_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "_digest",
        *names,
    )
    open_rows = narrow.filter("_digest is not null")
    # The length joins as a value of its own, so both sides are dealt out for the join
    # and a group with a third of the rows can be split.
    groups = open_rows.groupBy("_prefix", "_digest").agg(
        F.max("_len").alias("_len"), F.max("_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    grouped = open_rows.join(groups, ["_len", "_prefix", "_digest"]).select(
        F.col("_id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "_digest",
        *names,
    )
    return single.unionByName(grouped)
