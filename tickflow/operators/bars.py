"""Tumbling event-time bars. The same functions serve batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.spec import BarSpec


def _bar(spec: BarSpec):
    return F.window("event_ts", f"{spec.bar_seconds} seconds")


def _stamp(bars: DataFrame) -> DataFrame:
    """A bar is stamped with the start of its window."""
    names = [c for c in bars.columns if c not in ("window", "product_id")]
    return bars.select(
        "product_id", F.col("window.start").cast("timestamp_ntz").alias("bar_ts"), *names
    )


def trade_bars(matches: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """Count, volume, notional, volume by maker side, and the price range."""
    size, price, side = F.col("size"), F.col("price"), F.col("side")

    def volume_of(name: str):
        return F.sum(F.when(side == name, size).otherwise(F.lit(0.0)))

    return _stamp(
        matches.groupBy("product_id", _bar(spec)).agg(
            F.count(F.lit(1)).alias("trade_count"),
            F.sum(size).alias("volume"),
            F.sum(size * price).alias("notional"),
            volume_of("buy").alias("maker_buy_volume"),
            volume_of("sell").alias("maker_sell_volume"),
            F.min(price).alias("price_min"),
            F.max(price).alias("price_max"),
        )
    )


def book_bars(tops: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """Mid, spread, depth and flow per bar; the close is the last to arrive."""
    return _stamp(
        tops.groupBy("product_id", _bar(spec)).agg(
            F.max_by("mid", "arrival_seq").alias("mid_close"),
            F.min("mid").alias("mid_min"),
            F.max("mid").alias("mid_max"),
            F.avg("spread").alias("spread_mean"),
            F.max("spread").alias("spread_max"),
            F.avg("bid_depth5").alias("bid_depth5_mean"),
            F.avg("ask_depth5").alias("ask_depth5_mean"),
            F.sum("ofi_delta").alias("ofi_sum"),
            F.count(F.lit(1)).alias("updates"),
            F.max("conn_epoch").alias("conn_epoch_max"),
        )
    )


def newest_bars(bars: DataFrame, arrival: str = "arrival_seq") -> DataFrame:
    """One bar per (product, bar_ts) from an at-least-once topic: the last wins."""
    rest = [c for c in bars.columns if c not in ("product_id", "bar_ts", arrival)]
    # Column by column: primitive buffers keep this a hash aggregate.
    return bars.groupBy("product_id", "bar_ts").agg(
        *[F.max_by(c, arrival).alias(c) for c in rest]
    )


def tagged_bars(book: DataFrame, trade: DataFrame) -> DataFrame:
    """Both bar streams as one, each row marked with its origin."""
    return book.withColumn("stream", F.lit("book")).unionByName(
        trade.withColumn("stream", F.lit("trade")), allowMissingColumns=True
    )


def stream_marks(tagged: DataFrame) -> DataFrame:
    """How far each stream has been consumed."""
    return tagged.groupBy("stream").agg(F.max("bar_ts").alias("high_water"))
