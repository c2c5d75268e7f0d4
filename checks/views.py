"""Market-data views derived from the driver's ``events`` table.

Every event yields one trade and one book message; every view grows with the
table. ``SQL`` holds the same views as common table expressions for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.functions.clock import micros
from tickflow.functions.flow import mid
from tickflow.operators import bars, book, gold, router
from tickflow.session import materialize, use_utc
from tickflow.spec import BarSpec, FeedSpec

# The events are sparse (a few per type and hour), so bars are minutes and the
# grid is hourly here. Chunks are small so that small tables span several.
BARS = BarSpec(
    bar_seconds=60,
    step_seconds=3600,
    train_coverage=10,
    serve_coverage=8,
    chunk_steps=96,
)
FEED = FeedSpec(chunk_rows=1 << 12, max_message_bytes=260, truncated_bytes=64)
WEEK_US = 7 * 86_400_000_000
FIRST_MONDAY_US = 1_704_067_200_000_000
NOW = "2024-01-28 00:00:00"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    week = F.floor((micros("ts") - F.lit(FIRST_MONDAY_US)) / F.lit(WEEK_US)).cast("long")
    return raw.select(
        "event_id",
        "ts",
        "user_id",
        F.col("event_type").alias("product_id"),
        "value",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        (week + 1).alias("epoch"),
    )


def _trade_id() -> Column:
    """Mostly increasing ids with some late fills."""
    return F.col("event_id") - F.when(F.col("k") % 10 == 0, 40).otherwise(0)


def _side() -> Column:
    return F.when(F.col("user_id") % 2 == 0, "buy").otherwise("sell")


def _size() -> Column:
    return (F.col("k") + 1).cast("double") / F.lit(10.0)


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed trades."""
    return events(spark, sf_dir).select(
        "product_id",
        _trade_id().alias("trade_id"),
        F.col("value").alias("price"),
        _size().alias("size"),
        _side().alias("side"),
        F.when(F.col("event_id") % 50 == 0, "last_match").otherwise("match").alias("type"),
        F.col("ts").alias("event_ts"),
        F.col("epoch").alias("conn_epoch"),
        F.col("event_id").alias("arrival_seq"),
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks(spark, sf_dir).where(F.col("type") == "match")


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tops of book with lively prices, straight from event columns."""
    level = F.lit(100.0) + F.col("value")
    bid = level - (F.col("k") + 1).cast("double") / F.lit(100.0)
    ask = level + (F.col("user_id") % 7 + 1).cast("double") / F.lit(100.0)
    return (
        events(spark, sf_dir)
        .withColumns({"best_bid": bid, "best_ask": ask})
        .select(
            "product_id",
            F.col("ts").alias("event_ts"),
            F.col("event_id").alias("arrival_seq"),
            mid(F.col("best_bid"), F.col("best_ask")).alias("mid"),
            (F.col("best_ask") - F.col("best_bid")).alias("spread"),
            (F.col("k") + 1).cast("double").alias("bid_depth5"),
            (F.col("user_id") % 97 + 1).cast("double").alias("ask_depth5"),
            ((F.col("k") - 50).cast("double") * F.lit(0.5)).alias("ofi_delta"),
            F.col("epoch").alias("conn_epoch"),
        )
    )


def trade_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.trade_bars(matches(spark, sf_dir), BARS)


def book_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.book_bars(quotes(spark, sf_dir), BARS)


def gold_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold(
        book_bars(spark, sf_dir),
        trade_bars(spark, sf_dir),
        BARS,
        built_at=F.lit(NOW).cast("timestamp_ntz"),
    )


_ISO = """date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")"""

# The trade message of an event; some are malformed or of another kind.
_TRADE_TEXT = """
CASE
  WHEN m = 7 THEN substring(whole, 1, 40)
  WHEN m = 11 THEN concat(whole, ',null] junk')
  WHEN m = 12 THEN concat(whole, '] junk')
  WHEN m = 13 THEN concat(whole, ' ', whole)
  WHEN m = 14 THEN concat('{', kind, ',', product, ',', rest, ',"more":{"a":"}"}}')
  WHEN m = 28 THEN concat('{', kind, ',"product_id":0,', rest, '}')
  WHEN m = 29 THEN concat('{', kind, ',"product_id":false,', rest, '}')
  WHEN m = 17 THEN concat('{', kind, ',', rest, '}')
  WHEN m = 27 THEN concat('{', kind, ',"product_id":"",', rest, '}')
  WHEN m = 37 THEN concat('{"type":"ticker",', product, ',', rest, '}')
  WHEN m BETWEEN 47 AND 49 THEN
    concat('{"type":"heartbeat",', product, ',"last_trade_id":', event_id + k % 3, '}')
  WHEN m = 57 THEN
    concat('{"type":"error","message":"slow","reason":"', product_id, '"}')
  WHEN m = 58 THEN '{"type":"error"}'
  WHEN m = 67 THEN concat('[', event_id, ']')
  WHEN m = 77 THEN '{"type":"subscriptions"}'
  WHEN m = 87 THEN concat('{', product, ',', rest, '}')
  ELSE whole
END
"""

# Ten levels per side in a snapshot; two changes in a delta, where k >= 90
# locks the book at 101 or clears the lock again.
_SNAPSHOT_TEXT = (
    "concat('{\"type\":\"snapshot\",', product, ',\"bids\":["
    + ",".join(f'[\"{p}\",\"5\"]' for p in range(100, 90, -1))
    + '],\"asks\":['
    + ",".join(f'[\"{p}\",\"5\"]' for p in range(101, 111))
    + "]}')"
)
_DELTA_TEXT = """
concat(
  '{"type":"l2update",', product, ',"changes":[["',
  CASE WHEN buy THEN 'buy' ELSE 'sell' END, '","',
  CASE WHEN buy THEN 100 - away ELSE 101 + away END, '","', k % 10, '"],["',
  CASE WHEN k >= 90 OR NOT buy THEN 'buy' ELSE 'sell' END, '","',
  CASE WHEN k >= 90 THEN 101 WHEN buy THEN 101 + k div 10 ELSE 100 - k div 10 END, '","',
  CASE WHEN k >= 98 THEN 3 WHEN k >= 90 THEN 0 ELSE user_id % 10 END,
  '"]', CASE WHEN m = 33 THEN ',["buy","n/a","1"],["sell","105"]' ELSE '' END,
  '],"time":"', iso, '"}')
"""


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages with envelope: even arrivals are trades, odd ones book."""
    e = events(spark, sf_dir)
    opens = e.groupBy("product_id", "epoch").agg(F.min("event_id").alias("event_id"))
    opens = opens.select("event_id", F.lit(True).alias("is_snapshot"))
    marked = e.join(opens, "event_id", "left").withColumn(
        "is_snapshot", F.coalesce("is_snapshot", F.lit(False))
    )
    parts = marked.selectExpr(
        "*",
        "event_id % 100 AS m",
        f"{_ISO} AS iso",
        "user_id % 2 = 0 AS buy",
        "CAST(floor(value / 10D) AS BIGINT) AS away",
        """concat('"product_id":"', product_id, '"') AS product""",
        """CASE WHEN event_id % 50 = 0 THEN '"type":"last_match"'
                ELSE '"type":"match"' END AS kind""",
    ).selectExpr(
        "*",
        """concat('"trade_id":', event_id - CASE WHEN k % 10 = 0 THEN 40 ELSE 0 END,
                  ',"price":"', value, '","size":"', CAST(k + 1 AS DOUBLE) / 10D,
                  '","side":"', CASE WHEN buy THEN 'buy' ELSE 'sell' END, '","time":"',
                  CASE WHEN m = 97 THEN concat(substring(iso, 1, 19), 'Z') ELSE iso END,
                  '"') AS rest""",
    )
    texts = parts.selectExpr(
        "*", "concat('{', kind, ',', product, ',', rest, '}') AS whole"
    ).selectExpr(
        "event_id",
        "iso",
        "epoch",
        "CASE WHEN NOT is_snapshot AND user_id % 31 = 0 THEN epoch - 1 ELSE epoch END AS held",
        f"{_TRADE_TEXT} AS trade_text",
        f"CASE WHEN is_snapshot THEN {_SNAPSHOT_TEXT} ELSE {_DELTA_TEXT} END AS book_text",
    )
    return texts.selectExpr(
        """inline(array(
             struct(trade_text AS value, event_id * 2 AS arrival_seq, epoch AS conn_epoch),
             struct(book_text AS value, event_id * 2 + 1 AS arrival_seq, held AS conn_epoch)))""",
        "iso AS ingest_ts",
    )


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return router.route(feed(spark, sf_dir))


def feed_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return router.trades(routed(spark, sf_dir))


def book_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return router.book_messages(routed(spark, sf_dir))


def landed_trades(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Trades and heartbeats, parsed once and written."""
    rows = routed(spark, sf_dir).where(F.col("route").isin("trades", "heartbeat"))
    table = materialize(rows.drop("value"), "trade-messages", partition_by="route")
    return router.trades(table), router.heartbeats(table)


def landed_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Book messages parsed once and written, as the feed landing job does."""
    return materialize(book_messages(spark, sf_dir), "book-messages")


def book_tops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.book_tops(landed_books(spark, sf_dir), FEED)
