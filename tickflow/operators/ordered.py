"""Ordered per-key operators that do not put a whole key into one task.

A plain ``Window.partitionBy(key).orderBy(order)`` sends a hot key to a single
task. Here the order is cut into chunks; every chunk is processed on its own
and receives what it must know about the past from a one-row-per-chunk summary.
The chunk column has to be non-decreasing in the order column.

What a chunk must know enters its window as one extra first row, so the bulk of
the rows is shuffled and sorted once and joined with nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F


CARRY = "_carry"


@dataclass(frozen=True)
class Carried:
    """One output column: how to summarise a chunk, carry it, and finish it."""

    out: str
    summary: Column
    carry: Callable[[str, WindowSpec], Column]
    local: Callable[[WindowSpec], Column]
    finish: Callable[[Column, Column], Column]


def previous(col: str, out: str, order: str) -> Carried:
    """Value of ``col`` in the row before this one (NULL values are values)."""
    boxed = F.when(~F.col(CARRY), F.struct(F.col(col).alias("v")))
    # Boxed after aggregating: struct buffers would force a sort-based aggregate.
    return Carried(
        out,
        F.struct(F.max_by(F.col(col), F.col(order)).alias("v")),
        lambda name, w: F.lag(name).over(w),
        lambda w: F.lag(boxed).over(w),
        lambda local, carried: F.coalesce(local, carried)["v"],
    )


def running_max(col: str, out: str, inclusive: bool = False) -> Carried:
    """Largest non-NULL value of ``col`` so far."""
    end = 0 if inclusive else -1
    return Carried(
        out,
        F.max(col),
        lambda name, w: F.max(name).over(w.rowsBetween(W.unboundedPreceding, -1)),
        lambda w: F.max(col).over(w.rowsBetween(W.unboundedPreceding, end)),
        lambda local, carried: F.greatest(local, carried),
    )


def running_sum(col: str, out: str) -> Carried:
    """Sum of ``col`` up to and including this row."""
    zero = F.lit(0)
    return Carried(
        out,
        F.sum(col),
        lambda name, w: F.sum(name).over(w.rowsBetween(W.unboundedPreceding, -1)),
        lambda w: F.sum(col).over(w.rowsBetween(W.unboundedPreceding, 0)),
        lambda local, carried: F.coalesce(local, zero) + F.coalesce(carried, zero),
    )


def running_last(col: str, when: Column, out: str, order: str) -> Carried:
    """``col`` of the latest row, this one included, for which ``when`` holds."""
    boxed = F.when(when & ~F.col(CARRY), F.struct(F.col(col).alias("v")))
    return Carried(
        out,
        F.when(
            F.max(F.when(when, F.lit(1))).isNotNull(),
            F.struct(F.max_by(F.col(col), F.when(when, F.col(order))).alias("v")),
        ),
        lambda name, w: F.last(name, ignorenulls=True).over(
            w.rowsBetween(W.unboundedPreceding, -1)
        ),
        lambda w: F.last(boxed, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)),
        lambda local, carried: F.coalesce(local, carried)["v"],
    )


def over_chunks(
    df: DataFrame, key: str, order: str, chunk: str, columns: Sequence[Carried]
) -> DataFrame:
    """Add ``columns`` to ``df``, one ordered pass per (key, chunk)."""
    parts = [f"_s{i}" for i in range(len(columns))]
    chunks = df.groupBy(key, chunk).agg(
        *[c.summary.alias(p) for c, p in zip(columns, parts, strict=True)]
    )
    past = W.partitionBy(key).orderBy(chunk)
    carried = chunks.select(
        key,
        chunk,
        F.lit(True).alias(CARRY),
        *[c.carry(p, past).alias(p) for c, p in zip(columns, parts, strict=True)],
    )
    every = df.withColumn(CARRY, F.lit(False)).unionByName(carried, allowMissingColumns=True)
    # The carry row has no order value: NULL sorts first.
    here = W.partitionBy(key, chunk).orderBy(F.col(order).asc_nulls_first())
    so_far = here.rowsBetween(W.unboundedPreceding, 0)
    return (
        every.withColumns(
            {
                c.out: c.finish(c.local(here), F.first(p).over(so_far))
                for c, p in zip(columns, parts, strict=True)
            }
        )
        .where(~F.col(CARRY))
        .drop(CARRY, *parts)
    )


def arrival_chunk(df: DataFrame, rows: int, arrival: str = "arrival_seq") -> DataFrame:
    """Cut the arrival order into ranges of at most ``rows`` arrival numbers."""
    seq = F.col(arrival)
    return df.withColumn("chunk", ((seq - F.pmod(seq, F.lit(rows))) / F.lit(rows)).cast("long"))


def trailing_sums(
    rows: DataFrame, key: str, clock: str, sums: dict[str, Column], seconds: int, chunk_seconds: int
) -> DataFrame:
    """Add sums over each row's trailing window ``(t - seconds, t]``; peers count.

    ``sums`` has a column for each name. Time is cut into chunks at least as long as the
    window, and a row is copied into the next chunk where windows reach back to it, so a
    key is spread over as many tasks as it has chunks.
    """
    if chunk_seconds < seconds:
        raise ValueError("chunks must be at least as long as the window")
    us, span = seconds * 1_000_000, chunk_seconds * 1_000_000
    at = F.unix_micros(F.col(clock).cast("timestamp"))
    no = lambda t: ((t - F.pmod(t, F.lit(span))) / F.lit(span)).cast("long")
    inner = [f"_v{i}" for i in range(len(sums))]
    wide = rows.withColumns({"_at": at} | dict(zip(inner, sums.values(), strict=True)))
    reach = F.sequence(no(F.col("_at")), no(F.col("_at") + (us - 1)))
    spread = wide.withColumn("_home", no(F.col("_at"))).withColumn("_chunk", F.explode(reach))
    w = W.partitionBy(key, "_chunk").orderBy("_at").rangeBetween(-(us - 1), 0)
    # Windows are worked out before copies are dropped.
    summed = spread.withColumns(
        {name: F.sum(v).over(w) for name, v in zip(sums, inner, strict=True)}
    )
    return summed.where("_chunk = _home").drop("_at", "_home", "_chunk", *inner)
