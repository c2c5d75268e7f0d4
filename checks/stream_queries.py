"""Streaming operators, drained over the whole tables, against batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as V
from checks.queries import _BB, _GOLD, _TB, now, register, shape
from checks.sql import table
from checks.views import BARS, FEED
from tickflow import schemas
from tickflow.operators import book, router
from tickflow.plans import refresh
from tickflow.session import materialize, scratch_path, write_scratch
from tickflow.sources.topics import FileTopic
from tickflow.streaming import bars as stream_bars
from tickflow.streaming import online
from tickflow.streaming import scoring as stream_scoring

# Only windows that ended before the final watermark have been emitted.
_CLOSED = "bar_ts + INTERVAL 1 MINUTE <= (SELECT max({clock}) FROM {rows}) - INTERVAL 30 SECOND"


def drain(stream, name: str, schema):
    """Run a stream over all available input and read back its table."""
    spark = stream.sparkSession
    path, log = scratch_path(spark, name), scratch_path(spark, f"{name}-log")
    query = stream_bars.to_table(stream, path, log, every=None)
    query.awaitTermination()
    return spark.read.schema(schema).parquet(path)


_FEED_BARS = """
(SELECT product_id, date_trunc('minute', ts) AS bar_ts, count(*) AS trade_count,
        sum(CAST(k + 1 AS DOUBLE) / 10) AS volume,
        sum(CAST(k + 1 AS DOUBLE) / 10 * value) AS notional,
        sum(CASE WHEN user_id % 2 = 0 THEN CAST(k + 1 AS DOUBLE) / 10 ELSE 0 END)
          AS maker_buy_volume,
        sum(CASE WHEN user_id % 2 = 1 THEN CAST(k + 1 AS DOUBLE) / 10 ELSE 0 END)
          AS maker_sell_volume,
        min(value) AS price_min, max(value) AS price_max
 FROM slots WHERE route = 'trades' AND type = 'match' AND m <> 97 GROUP BY 1, 2)
"""
_LIVE = "(SELECT ts FROM slots WHERE route = 'trades' AND type = 'match' AND m <> 97)"


@register(
    "stream_trade_bars",
    table(f"{_FEED_BARS} WHERE {_CLOSED.format(clock='ts', rows=_LIVE)}", *_TB, "slots"),
)
def _(spark, d):
    raw = FileTopic(write_scratch(V.feed(spark, d), "feed")).stream(spark)
    closed = stream_bars.trade_bars(raw, BARS, FEED)
    return shape(drain(closed, "trade-bars", schemas.TRADE_BAR), *_TB)


_TOP_BARS = """
(SELECT product_id, date_trunc('minute', make_timestamp(ts_ms * 1000)) AS bar_ts,
        arg_max(mid, arrival_seq) AS mid_close, min(mid) AS mid_min, max(mid) AS mid_max,
        avg(spread) AS spread_mean, max(spread) AS spread_max,
        avg(bid_depth5) AS bid_depth5_mean, avg(ask_depth5) AS ask_depth5_mean,
        sum(ofi_delta) AS ofi_sum, count(*) AS updates, max(conn_epoch) AS conn_epoch_max
 FROM tops GROUP BY 1, 2)
"""


@register(
    "stream_book_bars",
    table(f"{_TOP_BARS} WHERE {_CLOSED.format(clock='ts', rows='e')}", *_BB, "tops"),
)
def _(spark, d):
    stream_bars.use_state_store(spark)
    raw = FileTopic(write_scratch(V.feed(spark, d), "feed")).stream(spark)
    closed = stream_bars.book_bars(raw, BARS, FEED)
    return shape(drain(closed, "book-bars", schemas.BOOK_BAR), *_BB)


_TAKEN = (
    "product_id arrival_seq segment conn_epoch",
    "best_bid best_bid_qty best_ask best_ask_qty bid_depth5 ask_depth5 mid spread ofi_delta",
)


@register("stream_takeover", table("tops", *_TAKEN, "tops"))
def _(spark, d):
    # A batch up to the middle of the feed; a stream goes on from the books it left.
    stream_bars.use_state_store(spark)
    rows = V.feed(spark, d)
    half = F.col("arrival_seq") < F.lit(rows.agg(F.max("arrival_seq")).first()[0] // 2)
    first = materialize(router.book_messages(router.route(rows.where(half))), "first-half")
    done = materialize(book.book_tops(first, FEED), "first-tops")
    opening = materialize(book.closing_books(first, done, FEED), "closing-books")
    raw = FileTopic(write_scratch(rows.where(~half), "feed")).stream(spark)
    live = stream_bars.book_tops(raw, FEED, opening)
    rest = drain(live, "rest-tops", live.schema)
    columns = [c for part in _TAKEN for c in part.split()]
    return shape(done.select(columns).unionByName(rest.select(columns)), *_TAKEN)


# Gold over the bars that the live job has closed.
_LIVE_BARS = {
    "trade_bars": (
        ("slots",),
        f"SELECT * FROM {_FEED_BARS} WHERE {_CLOSED.format(clock='ts', rows=_LIVE)}",
    ),
    "book_bars": (
        ("e", "tops"),
        f"SELECT * FROM {_TOP_BARS} WHERE {_CLOSED.format(clock='ts', rows='e')}",
    ),
}


@register("stream_gold", table("gold", *_GOLD, "gold", instead=_LIVE_BARS))
def _(spark, d):
    # Feed to streams to day tables to gold; the bars are also sent to topics.
    raw = FileTopic(write_scratch(V.feed(spark, d), "feed")).stream(spark)
    topic = scratch_path(spark, "live-topics")
    job = stream_bars.BarsJob(
        refresh.live_trade_bars(scratch_path(spark, "live-trade-bars")),
        refresh.live_book_bars(scratch_path(spark, "live-book-bars")),
        scratch_path(spark, "live-log"),
        [stream_bars.to_topic("bars.trade", f"{topic}/trade")],
        [stream_bars.to_topic("bars.book", f"{topic}/book")],
    )
    for query in job.start(raw, BARS, FEED, every=None):
        query.awaitTermination()
    target = refresh.gold_table(scratch_path(spark, "live-gold"))
    refresh.refresh(spark, job.book, job.trade, target, BARS, built_at=now())
    return shape(target.read(spark), *_GOLD)


def bar_stream(spark, df, name: str):
    """A stream over a written copy of a bar table."""
    zoned = df.withColumn("bar_ts", F.col("bar_ts").cast("timestamp"))
    return spark.readStream.schema(zoned.schema).parquet(write_scratch(zoned, name))


# The online path asks for a point whenever a book bar arrives, once both
# streams are two seconds past it, and has no start-up period.
_ONLINE = """
(WITH points AS (
   SELECT DISTINCT product_id, date_trunc('hour', bar_ts) AS as_of_ts FROM book_bars
   WHERE least((SELECT max(bar_ts) FROM book_bars), (SELECT max(bar_ts) FROM trade_bars))
         >= date_trunc('hour', bar_ts) + INTERVAL 2 SECOND)
 SELECT p.product_id, p.as_of_ts,
   sqrt(sum(r.ret * r.ret) FILTER (r.bar_ts > p.as_of_ts - INTERVAL 1 HOUR)) AS rv_1m,
   sqrt(sum(r.ret * r.ret) FILTER (r.bar_ts > p.as_of_ts - INTERVAL 5 HOUR)) AS rv_5m,
   sqrt(sum(r.ret * r.ret) FILTER (r.bar_ts > p.as_of_ts - INTERVAL 15 HOUR)) AS rv_15m,
   sqrt(sum(r.ret * r.ret)) AS rv_60m,
   sum(r.ofi_sum) FILTER (r.bar_ts > p.as_of_ts - INTERVAL 5 HOUR) AS ofi_5m,
   avg(r.spread_mean) FILTER (r.bar_ts > p.as_of_ts - INTERVAL 5 HOUR) AS spread_mean_5m,
   count(*) FILTER (r.bar_ts > p.as_of_ts - INTERVAL 5 HOUR) AS bar_count_5m,
   (SELECT coalesce(sum(t.volume), 0) FROM trade_bars t
    WHERE t.product_id = p.product_id AND t.bar_ts > p.as_of_ts - INTERVAL 5 HOUR
      AND t.bar_ts <= p.as_of_ts) AS volume_5m
 FROM points p JOIN rets r
   ON r.product_id = p.product_id AND r.bar_ts > p.as_of_ts - INTERVAL 60 HOUR
  AND r.bar_ts <= p.as_of_ts
 GROUP BY 1, 2
 HAVING bar_count_5m > 0 AND sum(r.ret * r.ret) > 0)
"""
_ONLINE_COLUMNS = (
    "product_id as_of_ts bar_count_5m",
    "rv_1m rv_5m rv_15m rv_60m ofi_5m spread_mean_5m volume_5m",
)


@register(
    "stream_online_features", table(_ONLINE, *_ONLINE_COLUMNS, "rets", "trade_bars")
)
def _(spark, d):
    stream_bars.use_state_store(spark)
    live = online.online_features(
        bar_stream(spark, V.book_bars(spark, d), "book-bars"),
        bar_stream(spark, V.trade_bars(spark, d), "trade-bars"),
        BARS,
        FEED,
        delay="0 seconds",  # the views deliver their bars in order
    )
    rows = drain(live, "online", online.OnlineFeatures.output)
    return shape(
        rows.withColumn("as_of_ts", F.col("as_of_ts").cast("timestamp_ntz")), *_ONLINE_COLUMNS
    )


def _feature_stream(spark, d, copies: int = 1):
    """Gold rows as a live feature stream, each delivered ``copies`` times."""
    rows = V.gold_rows(spark, d).withColumn("as_of_ts", F.col("as_of_ts").cast("timestamp"))
    rows = rows.drop("label_ts", "built_at")
    many = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
    return spark.readStream.schema(rows.schema).parquet(write_scratch(many, "features"))


def _forecast():
    return (F.col("rv_5m") + F.col("rv_60m")) / F.lit(2.0)


def _unzoned(df):
    stamps = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


_PRED = ("product_id as_of_ts label_ts model_version", "pred_rv pred_persistence")


@register("stream_predictions", table("preds", *_PRED, "preds"))
def _(spark, d):
    # At-least-once delivery: every row comes twice and is scored once.
    stream_bars.use_state_store(spark)
    live = stream_scoring.score(
        _feature_stream(spark, d, copies=2), _forecast(), F.lit("mean-v1"), BARS
    )
    return shape(_unzoned(drain(live, "predictions", live.schema)), *_PRED)


@register(
    "stream_labels",
    table("labeled WHERE label_rv IS NOT NULL", "product_id as_of_ts", "pred_rv label_rv", "labeled"),
)
def _(spark, d):
    stream_bars.use_state_store(spark)
    scored = V.gold_rows(spark, d).withColumns(
        {
            "as_of_ts": F.col("as_of_ts").cast("timestamp"),
            "pred_rv": _forecast(),
            "pred_persistence": F.col("rv_5m"),
        }
    ).where(F.col("bar_count_5m") >= BARS.serve_coverage)
    scored = scored.select("product_id", "as_of_ts", "pred_rv", "pred_persistence")
    stored = spark.readStream.schema(scored.schema).parquet(write_scratch(scored, "predictions"))
    live = stream_scoring.labels(stored, _feature_stream(spark, d), BARS)
    rows = _unzoned(drain(live, "labels", live.schema))
    return shape(rows, "product_id as_of_ts", "pred_rv label_rv")
