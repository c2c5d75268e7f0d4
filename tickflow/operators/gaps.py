"""Trade-id continuity: as seen in arrival order, and after sorting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickflow.operators.ordered import (
    arrival_chunk,
    over_chunks,
    previous,
    running_max,
    running_sum,
)
from tickflow.spec import FeedSpec


def running_gaps(
    trade_rows: DataFrame, heartbeat_rows: DataFrame, spec: FeedSpec = FeedSpec()
) -> DataFrame:
    """Ids skipped against the running maximum, trades and heartbeats alike.

    A heartbeat counts only once a trade has been seen; then it also raises the
    maximum. Late ids never lower it. Rows without an integer id are ignored.
    """
    trades = trade_rows.where("trade_id IS NOT NULL").select(
        "product_id",
        "arrival_seq",
        F.col("trade_id").alias("id"),
        F.lit(1).alias("is_trade"),
        (F.col("type") == "last_match").alias("across_reconnect"),
    )
    # Only heartbeats, about one a second, meet the per-product first trade.
    first = trades.groupBy("product_id").agg(F.min("arrival_seq").alias("first_trade"))
    beats = (
        heartbeat_rows.where("last_trade_id IS NOT NULL")
        .join(first, "product_id")
        .where(F.col("arrival_seq") > F.col("first_trade"))
        .select(
            "product_id",
            "arrival_seq",
            F.col("last_trade_id").alias("id"),
            F.lit(0).alias("is_trade"),
            F.lit(False).alias("across_reconnect"),
        )
    )
    tracked = over_chunks(
        arrival_chunk(trades.unionByName(beats), spec.chunk_rows),
        "product_id",
        "arrival_seq",
        "chunk",
        [running_max("id", "prev_id")],
    )
    gap = F.col("id") - F.col("prev_id") - F.col("is_trade")
    return tracked.select(
        "product_id",
        "arrival_seq",
        "id",
        "prev_id",
        (F.col("is_trade") == 1).alias("is_trade"),
        "across_reconnect",
        F.coalesce(F.greatest(gap, F.lit(0)), F.lit(0)).cast("long").alias("missed"),
    )


def sorted_gaps(trade_rows: DataFrame, spec: FeedSpec = FeedSpec()) -> DataFrame:
    """Gaps that remain after sorting ids: (product, gap_from, gap_to, missed).

    Only `match` rows count; late fills close a gap and repeated ids are no gap.
    """
    ids = trade_rows.where((F.col("type") == "match") & F.col("trade_id").isNotNull())
    ids = arrival_chunk(ids.select("product_id", "trade_id").distinct(), spec.chunk_rows, "trade_id")
    steps = over_chunks(
        ids, "product_id", "trade_id", "chunk", [previous("trade_id", "prev_id", "trade_id")]
    )
    return steps.where(F.col("trade_id") - F.col("prev_id") > 1).select(
        "product_id",
        F.col("prev_id").alias("gap_from"),
        F.col("trade_id").alias("gap_to"),
        (F.col("trade_id") - F.col("prev_id") - 1).alias("missed"),
    )


def gap_report(trade_rows: DataFrame, spec: FeedSpec = FeedSpec()) -> DataFrame:
    """One row per product: trades, id range, gaps, missed ids, epochs seen."""
    rows = trade_rows.where((F.col("type") == "match") & F.col("trade_id").isNotNull())
    totals = rows.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("trades"),
        F.min("trade_id").alias("first_id"),
        F.max("trade_id").alias("last_id"),
        F.array_join(F.array_sort(F.collect_set("conn_epoch")), ",").alias("epochs"),
    )
    gaps = (
        sorted_gaps(trade_rows, spec)
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("gaps"), F.sum("missed").alias("missed"))
    )
    return totals.join(gaps, "product_id", "left").na.fill(0, ["gaps", "missed"])


def first_gaps(gaps: DataFrame, n: int = 5) -> DataFrame:
    """The first n gaps of each product, for a report."""
    w = W.partitionBy("product_id").orderBy("gap_from")
    return gaps.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def gap_share(running: DataFrame) -> DataFrame:
    """Missed ids per hundred trades, per product."""
    trades = F.count_if("is_trade")
    return running.groupBy("product_id").agg(
        F.sum("missed").alias("missed"),
        trades.alias("trades"),
        (F.lit(100.0) * F.sum("missed") / F.nullif(trades, F.lit(0))).alias("gap_percent"),
    )


def connection_epochs(raw_log: DataFrame, spec: FeedSpec = FeedSpec()) -> DataFrame:
    """Number connections by the subscription acknowledgement that opens each.

    The log of one collector is one sequence; chunks keep it parallel.
    """
    opened = arrival_chunk(
        raw_log.withColumns(
            {
                "_opens": F.when(F.col("route") == "control", 1).otherwise(0),
                "_log": F.lit(0),
            }
        ),
        spec.chunk_rows,
    )
    return over_chunks(
        opened, "_log", "arrival_seq", "chunk", [running_sum("_opens", "epoch")]
    ).drop("_opens", "_log", "chunk")
