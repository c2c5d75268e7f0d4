"""One query per operator over the driver tables, and its SQL counterpart.

``QUERIES[name]`` takes (spark, sf_dir); ``ORACLES[name]`` is SQL for the same
rows. Queries without an oracle are not expressible in SQL (fitted models).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from checks import views as V
from checks.sql import query, rounding, table
from checks.views import BARS, FEED, NOW
from tickflow import schemas
from tickflow.functions.clock import micros, step_time, trade_event_time
from tickflow.operators import (
    bars,
    book,
    gaps,
    gold,
    modelling,
    monitor,
    predictions,
    quality,
    router,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def shape(df: DataFrame, plain: str, doubles: str = "", digits: int = 6) -> DataFrame:
    """Columns in order, doubles rounded (sums differ in the last bits)."""
    rounded = [
        (F.round(F.col(c), n) + F.lit(0.0)).alias(c) for c, n in rounding(doubles, digits)
    ]
    return df.select(*plain.split(), *rounded)


def now():
    return F.lit(NOW).cast("timestamp_ntz")


# --- bars ------------------------------------------------------------------

_TB = ("product_id bar_ts trade_count",
       "volume notional maker_buy_volume maker_sell_volume price_min price_max")
_BB = ("product_id bar_ts updates conn_epoch_max",
       "mid_close mid_min mid_max spread_mean spread_max bid_depth5_mean ask_depth5_mean ofi_sum")


@register("trade_bars", table("trade_bars", *_TB, "trade_bars"))
def _(spark, d):
    return shape(V.trade_bars(spark, d), *_TB)


@register("book_bars", table("book_bars", *_BB, "book_bars"))
def _(spark, d):
    return shape(V.book_bars(spark, d), *_BB)


@register(
    "matches_only",
    query(
        """SELECT product_id, arrival_seq, trade_id FROM feed_trades WHERE type = 'match'""",
        "feed_trades",
    ),
)
def _(spark, d):
    return router.matches(V.feed_trades(spark, d)).select("product_id", "arrival_seq", "trade_id")


@register(
    "event_time_parse",
    query(
        """SELECT arrival_seq,
                  CASE WHEN m = 97 THEN TIMESTAMP '1970-01-01 00:00:00'
                       ELSE CAST(substr(replace(iso, 'T', ' '), 1, 23) AS TIMESTAMP) END AS event_ts
           FROM feed_trades""",
        "feed_trades",
    ),
)
def _(spark, d):
    return V.feed_trades(spark, d).select("arrival_seq", trade_event_time("time").alias("event_ts"))


@register(
    "feed_trade_bars",
    query(
        """SELECT product_id, date_trunc('minute', ts) AS bar_ts, count(*) AS trade_count,
                  round(sum(CAST(k + 1 AS DOUBLE) / 10), 6) AS volume,
                  round(sum(CAST(k + 1 AS DOUBLE) / 10 * value), 6) AS notional
           FROM slots WHERE route = 'trades' AND type = 'match' AND m <> 97 GROUP BY 1, 2""",
        "slots",
    ),
)
def _(spark, d):
    # Unreadable clocks fall to 1970: late in a stream, filtered out in batch.
    on_time = router.matches(V.feed_trades(spark, d)).where("event_ts > '1970-01-01'")
    return shape(bars.trade_bars(on_time, BARS), "product_id bar_ts trade_count", "volume notional")


@register("dedup_bars", table("trade_bars", *_TB, "trade_bars"))
def _(spark, d):
    # Every bar delivered twice; the second delivery wins.
    first = V.trade_bars(spark, d)
    late = first.withColumn("arrival_seq", F.lit(2))
    early = first.withColumns({"volume": F.lit(-1.0), "arrival_seq": F.lit(1)})
    return shape(bars.newest_bars(early.unionByName(late)), *_TB)


@register(
    "union_bar_streams",
    query(
        """SELECT 'book' AS stream, product_id, bar_ts, updates AS n FROM book_bars
           UNION ALL SELECT 'trade', product_id, bar_ts, trade_count FROM trade_bars""",
        "book_bars",
        "trade_bars",
    ),
)
def _(spark, d):
    both = bars.tagged_bars(V.book_bars(spark, d), V.trade_bars(spark, d))
    return both.select(
        "stream", "product_id", "bar_ts", F.coalesce("updates", "trade_count").alias("n")
    )


@register(
    "stream_high_water",
    query(
        """SELECT 'book' AS stream, max(bar_ts) AS high_water FROM book_bars
           UNION ALL SELECT 'trade', max(bar_ts) FROM trade_bars""",
        "book_bars",
        "trade_bars",
    ),
)
def _(spark, d):
    return bars.stream_marks(bars.tagged_bars(V.book_bars(spark, d), V.trade_bars(spark, d)))


# --- routing ---------------------------------------------------------------


@register(
    "route_messages",
    query(
        """SELECT arrival_seq, route, error FROM texts
           UNION ALL SELECT event_id * 2 + 1, 'book', NULL FROM e""",
        "texts",
    ),
)
def _(spark, d):
    return V.routed(spark, d).select("arrival_seq", "route", "error")


@register(
    "route_counts",
    query(
        """SELECT route, count(*) AS n FROM (SELECT route FROM texts
           UNION ALL SELECT 'book' FROM e) GROUP BY 1""",
        "texts",
    ),
)
def _(spark, d):
    return router.counters(V.routed(spark, d))


@register(
    "feed_counters",
    query(
        """SELECT route AS kind, count(*) AS n FROM (SELECT route FROM texts
           UNION ALL SELECT 'book' FROM e) WHERE route <> 'control' GROUP BY 1
           UNION ALL SELECT 'trade_gaps', CAST(sum(missed) AS BIGINT) FROM running_gaps
           UNION ALL SELECT 'reconnects', greatest(count(*) - 1, 0) FROM texts
             WHERE route = 'control'""",
        "texts",
        "running_gaps",
    ),
)
def _(spark, d):
    return monitor.feed_counters(V.routed(spark, d), _running(spark, d))


@register(
    "dlq_records",
    query(
        "SELECT arrival_seq, raw, error, iso AS ingest_ts FROM texts WHERE route = 'dlq'", "texts"
    ),
)
def _(spark, d):
    return router.dead_letters(V.routed(spark, d))


@register(
    "dlq_head",
    query(
        "SELECT arrival_seq, error FROM texts WHERE route = 'dlq' ORDER BY arrival_seq LIMIT 5",
        "texts",
    ),
)
def _(spark, d):
    return monitor.first_letters(router.dead_letters(V.routed(spark, d))).select(
        "arrival_seq", "error"
    )


@register(
    "unreadable_levels",
    query(
        """SELECT arrival_seq, value_text AS raw, 'unreadable levels in l2update: 2' AS error,
                  strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ingest_ts
           FROM snapshot_text WHERE value_text LIKE '%n/a%'""",
        "snapshot_text",
    ),
)
def _(spark, d):
    return router.unreadable_levels(V.routed(spark, d))


@register(
    "oversize_dlq",
    query(
        """SELECT arrival_seq, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ingest_ts,
                  'message too large (' || strlen(value_text) || ' bytes) for book' AS error,
                  substr(value_text, 1, 64) || '...' AS raw
           FROM snapshot_text WHERE strlen(value_text) > 260""",
        "snapshot_text",
    ),
)
def _(spark, d):
    return router.oversize_letters(V.routed(spark, d), FEED)


@register(
    "product_key",
    query(
        """SELECT arrival_seq, CASE WHEN m IN (7, 11, 12, 13, 17, 27, 28, 29, 57, 58, 67, 77) THEN 'unknown'
                                    ELSE product_id END AS key FROM texts
           UNION ALL SELECT event_id * 2 + 1, product_id FROM e""",
        "texts",
    ),
)
def _(spark, d):
    routed = V.routed(spark, d)
    return routed.select("arrival_seq", router.product_key(routed).alias("key"))


@register(
    "envelope",
    query(
        """SELECT event_id * 2 AS arrival_seq, epoch + 1 AS conn_epoch, iso AS ingest_ts FROM slots
           UNION ALL
           SELECT arrival_seq, epoch + 1 - CASE WHEN stale THEN 1 ELSE 0 END,
                  strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') FROM msgs""",
        "slots",
        "msgs",
    ),
)
def _(spark, d):
    raw = V.feed(spark, d)
    return router.envelope(raw, F.col("conn_epoch") + 1, F.col("ingest_ts")).select(
        "arrival_seq", "conn_epoch", "ingest_ts"
    )


@register(
    "product_allowlist",
    query(
        """SELECT arrival_seq FROM texts
           WHERE m IN (7, 11, 12, 13, 17, 27, 28, 29, 57, 58, 67, 77) OR product_id IN ('click', 'view')
           UNION ALL SELECT event_id * 2 + 1 FROM e WHERE product_id IN ('click', 'view')""",
        "texts",
    ),
)
def _(spark, d):
    listed = router.split_products("click, view,")
    return router.allow_products(V.routed(spark, d), listed).select("arrival_seq")


@register(
    "schema_evolution",
    query(
        """SELECT product_id, trade_id, arrival_seq FROM feed_trades""",
        "feed_trades",
    ),
)
def _(spark, d):
    # Every object gains a field nobody declared; nothing else may change.
    extra = F.regexp_replace("value", r"^\{", '{"venue":{"id":7},')
    wider = V.feed(spark, d).withColumn("value", extra)
    return router.trades(router.route(wider)).select("product_id", "trade_id", "arrival_seq")


@register(
    "message_rate",
    query(
        """SELECT date_trunc('hour', ts) AS window_ts, route, count(*) AS n,
                  round(count(*) / CAST(3600 AS DOUBLE), 6) AS per_second
           FROM (SELECT ts, route FROM slots UNION ALL SELECT ts, 'book' FROM e)
           GROUP BY 1, 2""",
        "slots",
    ),
)
def _(spark, d):
    timed = V.routed(spark, d).withColumn("ingested", F.col("ingest_ts").cast("timestamp"))
    return shape(
        monitor.message_rate(timed, "ingested", "1 hour"), "window_ts route n", "per_second"
    )


# --- gaps ------------------------------------------------------------------


def _running(spark, d):
    return gaps.running_gaps(*V.landed_trades(spark, d), FEED)


@register(
    "trade_gaps_running",
    query(
        """SELECT product_id, arrival_seq, id, prev_id, is_trade = 1 AS is_trade,
                  type = 'last_match' AS across_reconnect, CAST(missed AS BIGINT) AS missed
           FROM running_gaps""",
        "running_gaps",
    ),
)
def _(spark, d):
    return _running(spark, d)


@register(
    "heartbeat_reconcile",
    query(
        """SELECT product_id, arrival_seq, id, CAST(missed AS BIGINT) AS missed
           FROM running_gaps WHERE is_trade = 0 AND missed > 0""",
        "running_gaps",
    ),
)
def _(spark, d):
    return _running(spark, d).where("NOT is_trade AND missed > 0").select(
        "product_id", "arrival_seq", "id", "missed"
    )


@register(
    "gap_share",
    query(
        """SELECT product_id, CAST(sum(missed) AS BIGINT) AS missed,
                  CAST(sum(is_trade) AS BIGINT) AS trades,
                  round(CAST(100 AS DOUBLE) * sum(missed) / nullif(sum(is_trade), 0), 6)
                    AS gap_percent
           FROM running_gaps GROUP BY 1""",
        "running_gaps",
    ),
)
def _(spark, d):
    return shape(gaps.gap_share(_running(spark, d)), "product_id missed trades", "gap_percent")


@register("trade_gaps_sorted", query("SELECT * FROM sorted_gaps", "sorted_gaps"))
def _(spark, d):
    return gaps.sorted_gaps(V.feed_trades(spark, d), FEED)


@register(
    "first_gaps",
    query(
        """SELECT product_id, gap_from, gap_to, rank FROM
             (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY gap_from) AS rank
              FROM sorted_gaps) WHERE rank <= 5""",
        "sorted_gaps",
    ),
)
def _(spark, d):
    return gaps.first_gaps(gaps.sorted_gaps(V.feed_trades(spark, d), FEED)).select(
        "product_id", "gap_from", "gap_to", "rank"
    )


_GAP_REPORT = """
SELECT t.*, coalesce(g.gaps, 0) AS gaps, coalesce(g.missed, 0) AS missed FROM
  (SELECT product_id, count(*) AS trades, min(trade_id) AS first_id, max(trade_id) AS last_id,
          array_to_string(list_sort(list(DISTINCT conn_epoch)), ',') AS epochs
   FROM feed_trades WHERE type = 'match' GROUP BY 1) t
  LEFT JOIN (SELECT product_id, count(*) AS gaps, CAST(sum(missed) AS BIGINT) AS missed
             FROM sorted_gaps GROUP BY 1) g ON g.product_id = t.product_id
"""


@register("gap_report", query(_GAP_REPORT, "feed_trades", "sorted_gaps"))
def _(spark, d):
    return gaps.gap_report(V.landed_trades(spark, d)[0], FEED)


@register(
    "feed_gate",
    query(
        """SELECT (SELECT count(DISTINCT product_id) FROM feed_trades) AS products,
                  (SELECT count(*) FROM sorted_gaps) AS gaps,
                  (SELECT CAST(coalesce(sum(missed), 0) AS BIGINT) FROM sorted_gaps) AS missed,
                  (SELECT count(*) FROM texts WHERE route = 'dlq') AS dead_letters,
                  FALSE AS passed""",
        "sorted_gaps",
        "texts",
    ),
)
def _(spark, d):
    routed = V.routed(spark, d)
    return quality.feed_gate(router.trades(routed), router.dead_letters(routed), FEED)


@register(
    "conn_epochs",
    query(
        """SELECT arrival_seq, CAST(sum(CASE WHEN route = 'control' THEN 1 ELSE 0 END)
                                    OVER (ORDER BY arrival_seq) AS BIGINT) AS epoch
           FROM (SELECT arrival_seq, route FROM slots
                 UNION ALL SELECT event_id * 2 + 1, 'book' FROM e)""",
        "slots",
    ),
)
def _(spark, d):
    return gaps.connection_epochs(V.routed(spark, d), FEED).select("arrival_seq", "epoch")


# --- books -----------------------------------------------------------------


@register(
    "book_levels",
    query(
        """SELECT arrival_seq, is_snapshot, CASE WHEN is_snapshot THEN 20
                                          WHEN arrival_seq // 2 % 100 = 33 THEN 4 ELSE 2 END AS levels
           FROM msgs""",
        "msgs",
    ),
)
def _(spark, d):
    return V.book_messages(spark, d).select(
        "arrival_seq", "is_snapshot", F.size("price").alias("levels")
    )


@register(
    "book_segments",
    query("SELECT product_id, arrival_seq, segment, stale FROM seg", "seg"),
)
def _(spark, d):
    return book.segments(V.book_messages(spark, d), FEED).select(
        "product_id", "arrival_seq", "segment", "stale"
    )


@register(
    "stale_deltas",
    query(
        "SELECT product_id, count(*) FILTER (stale) AS dropped FROM seg GROUP BY 1", "seg"
    ),
)
def _(spark, d):
    return (
        book.segments(V.book_messages(spark, d), FEED)
        .groupBy("product_id")
        .agg(F.count_if("stale").alias("dropped"))
    )


_TOPS = (
    "product_id arrival_seq segment conn_epoch ts_ms",
    "best_bid best_bid_qty best_ask best_ask_qty mid spread bid_depth5 ask_depth5 ofi_delta",
)




@register("book_tops", table("tops", *_TOPS, "tops"))
def _(spark, d):
    return shape(V.book_tops(spark, d), *_TOPS)


@register(
    "book_depth5",
    table("tops", "product_id arrival_seq", "bid_depth5 ask_depth5", "tops"),
)
def _(spark, d):
    # Depth needs no flow, so the replay is read without closing it.
    tops = book.replay(V.landed_books(spark, d), FEED)
    return shape(tops, "product_id arrival_seq", "bid_depth5 ask_depth5")


@register(
    "order_flow",
    query(
        """SELECT product_id, segment, count(*) AS tops, round(sum(ofi_delta), 6) AS ofi
           FROM tops GROUP BY 1, 2""",
        "tops",
    ),
)
def _(spark, d):
    flow = V.book_tops(spark, d).groupBy("product_id", "segment")
    return shape(
        flow.agg(F.count(F.lit(1)).alias("tops"), F.sum("ofi_delta").alias("ofi")),
        "product_id segment tops",
        "ofi",
    )


_L2_BARS = """
SELECT product_id, date_trunc('minute', make_timestamp(ts_ms * 1000)) AS bar_ts,
       arg_max(mid, arrival_seq) AS mid_close, min(mid) AS mid_min, max(mid) AS mid_max,
       avg(spread) AS spread_mean, max(spread) AS spread_max, avg(bid_depth5) AS bid_depth5_mean,
       avg(ask_depth5) AS ask_depth5_mean, sum(ofi_delta) AS ofi_sum, count(*) AS updates,
       max(conn_epoch) AS conn_epoch_max
FROM tops GROUP BY 1, 2
"""


@register("l2_book_bars", table(f"({_L2_BARS})", *_BB, "tops"))
def _(spark, d):
    return shape(bars.book_bars(V.book_tops(spark, d), BARS), *_BB)


# --- gold ------------------------------------------------------------------

_GOLD = (
    "product_id as_of_ts label_ts trade_count_5m bar_count_5m label_bar_count",
    "rv_1m rv_5m rv_15m rv_60m ofi_5m spread_mean_5m spread_max_5m depth_imb_5m:10 volume_5m "
    "notional_5m taker_imb_5m:10 label_rv_5m",
)


@register("gold", table("gold", *_GOLD, "gold"))
def _(spark, d):
    return shape(V.gold_rows(spark, d), *_GOLD)


@register("log_returns", table("rets", "product_id bar_ts", "ret", "rets", digits=9))
def _(spark, d):
    return shape(
        gold.log_returns(V.book_bars(spark, d), BARS), "product_id bar_ts", "ret", digits=9
    )


@register("grid_bounds", query("SELECT product_id, start_ts, end_ts FROM bounds", "bounds"))
def _(spark, d):
    return gold.grid_bounds(V.book_bars(spark, d), BARS).select("product_id", "start_ts", "end_ts")


@register("minute_grid", query("SELECT product_id, as_of_ts FROM grid", "grid"))
def _(spark, d):
    points = gold.grid(gold.pending_bounds(gold.grid_bounds(V.book_bars(spark, d), BARS), None))
    return points.select("product_id", step_time("step", BARS.step_us).alias("as_of_ts"))


_RV = "rv_1m rv_5m rv_15m rv_60m"


@register("rv_trailing", table("book_agg", "product_id as_of_ts", _RV, "book_agg"))
def _(spark, d):
    return shape(V.gold_rows(spark, d), "product_id as_of_ts", _RV)


@register(
    "rv_label",
    table("book_agg", "product_id as_of_ts label_bar_count", "label_rv_5m", "book_agg"),
)
def _(spark, d):
    return shape(V.gold_rows(spark, d), "product_id as_of_ts label_bar_count", "label_rv_5m")


_BOOK_F = ("product_id as_of_ts bar_count_5m", "ofi_5m spread_mean_5m spread_max_5m depth_imb_5m:10")


@register("book_features", table("gold", *_BOOK_F, "gold"))
def _(spark, d):
    return shape(V.gold_rows(spark, d), *_BOOK_F)


_TRADE_F = ("product_id as_of_ts trade_count_5m", "volume_5m notional_5m taker_imb_5m:10")


@register("trade_features", table("gold", *_TRADE_F, "gold"))
def _(spark, d):
    return shape(V.gold_rows(spark, d), *_TRADE_F)


_HALF = "2024-01-15 00:00:00"


@register(
    "gold_incremental",
    table(f"gold WHERE as_of_ts > TIMESTAMP '{_HALF}'", *_GOLD, "gold"),
)
def _(spark, d):
    # An earlier build stopped mid-month; the next one adds only what is missing.
    books, trades = V.book_bars(spark, d), V.trade_bars(spark, d)
    built = V.gold_rows(spark, d).where(F.col("as_of_ts") <= F.lit(_HALF).cast("timestamp_ntz"))
    more = gold.gold(books, trades, BARS, built=gold.high_water(built), built_at=now())
    return shape(more, *_GOLD)


@register(
    "high_water",
    query("SELECT product_id, max(as_of_ts) AS high_water FROM gold GROUP BY 1", "gold"),
)
def _(spark, d):
    return gold.high_water(V.gold_rows(spark, d))


# --- quality ---------------------------------------------------------------


@register(
    "gold_quality",
    query(
        """SELECT count(*) - count(DISTINCT (product_id, as_of_ts)) AS duplicates,
                  count(*) FILTER (label_ts <> as_of_ts + INTERVAL 5 HOUR) AS bad_label_ts,
                  count(*) FILTER (bar_count_5m < 8 OR label_bar_count < 8) AS low_coverage
           FROM gold""",
        "gold",
    ),
)
def _(spark, d):
    return quality.gold_quality(V.gold_rows(spark, d), BARS)


@register(
    "gold_ranges",
    query(
        """SELECT min(bar_count_5m) AS min_bar_count, min(label_bar_count) AS min_label_bar_count,
                  round(min(rv_5m), 6) AS min_rv_5m,
                  round(min(spread_max_5m - spread_mean_5m), 6) + CAST(0 AS DOUBLE)
                    AS min_spread_slack,
                  min(bar_count_5m) >= 8 AND min(label_bar_count) >= 8 AND min(rv_5m) >= 0
                    AND min(spread_max_5m - spread_mean_5m) >= 0 AS passed
           FROM gold""",
        "gold",
    ),
)
def _(spark, d):
    return shape(
        quality.gold_ranges(V.gold_rows(spark, d), BARS),
        "min_bar_count min_label_bar_count passed",
        "min_rv_5m min_spread_slack",
    )


@register(
    "pit_recheck",
    query(
        """SELECT product_id, count(*) AS rows, CAST(0 AS BIGINT) AS leaky_features,
                  CAST(0 AS BIGINT) AS leaky_labels FROM gold GROUP BY 1""",
        "gold",
    ),
)
def _(spark, d):
    return quality.point_in_time(gold.recheck(V.gold_rows(spark, d), V.book_bars(spark, d), BARS))


# --- training --------------------------------------------------------------


def _train(spark, d):
    return modelling.train_rows(V.gold_rows(spark, d), BARS)


@register("gold_train_rows", table("train", *_GOLD, "train"))
def _(spark, d):
    return shape(_train(spark, d).orderBy("as_of_ts", "product_id"), *_GOLD)


@register("split_cut", query("SELECT cut FROM cut", "cut"))
def _(spark, d):
    return modelling.split_cut(_train(spark, d), BARS)


@register(
    "train_rows",
    query(
        "SELECT product_id, as_of_ts, label_ts FROM train, cut WHERE label_ts <= cut",
        "train",
        "cut",
    ),
)
def _(spark, d):
    return modelling.time_split(_train(spark, d), BARS)[0].select(
        "product_id", "as_of_ts", "label_ts"
    )


@register(
    "test_rows",
    query(
        "SELECT product_id, as_of_ts, label_ts FROM train, cut WHERE as_of_ts >= cut",
        "train",
        "cut",
    ),
)
def _(spark, d):
    return modelling.time_split(_train(spark, d), BARS)[1].select(
        "product_id", "as_of_ts", "label_ts"
    )


@register(
    "persistence_eval",
    query(
        """SELECT 'persistence' AS model, product_id, count(*) AS n,
                  round(avg(abs(label_rv_5m - rv_5m)), 6) AS mae,
                  round(sqrt(avg((label_rv_5m - rv_5m) * (label_rv_5m - rv_5m))), 6) AS rmse
           FROM train, cut WHERE as_of_ts >= cut
           GROUP BY GROUPING SETS ((), (product_id))""",
        "train",
        "cut",
    ),
)
def _(spark, d):
    test = modelling.with_persistence(modelling.time_split(_train(spark, d), BARS)[1])
    return shape(modelling.evaluate(test, ["persistence"]), "model product_id n", "mae rmse")


@register(
    "metric_names",
    query(
        """SELECT 'persistence_mae' || coalesce('_' || replace(product_id, '-', '_'), '') AS metric,
                  round(avg(abs(label_rv_5m - rv_5m)), 6) AS value
           FROM train GROUP BY GROUPING SETS ((), (product_id))
           UNION ALL
           SELECT 'persistence_rmse',
                  round(sqrt(avg((label_rv_5m - rv_5m) * (label_rv_5m - rv_5m))), 6) FROM train""",
        "train",
    ),
)
def _(spark, d):
    metrics = modelling.evaluate(modelling.with_persistence(_train(spark, d)), ["persistence"])
    return shape(modelling.metric_names(metrics), "metric", "value")


_HAR = [*schemas.HAR_FEATURES, schemas.LABEL]
_MOMENTS = [f"s_{c}" for c in _HAR] + [
    f"s_{a}_{b}" for i, a in enumerate(_HAR) for b in _HAR[i:]
]
_MOMENT_SQL = ", ".join(
    [f"sum({c}) AS s_{c}" for c in _HAR]
    + [f"sum({a} * {b}) AS s_{a}_{b}" for i, a in enumerate(_HAR) for b in _HAR[i:]]
)
_HAR_INPUTS = ", ".join(f"coalesce({c}, 0) AS {c}" for c in schemas.HAR_FEATURES)


@register(
    "har_moments",
    table(
        f"(SELECT count(*) AS n, {_MOMENT_SQL} FROM "
        f"(SELECT label_rv_5m, {_HAR_INPUTS} FROM train))",
        "n",
        " ".join(_MOMENTS),
        "train",
        digits=4,
    ),
)
def _(spark, d):
    return shape(modelling.har_moments(_train(spark, d)), "n", " ".join(_MOMENTS), digits=4)


# Imbalances are ratios of small whole numbers: fewer digits would hit ties.
_VECTOR = " ".join(f"{c}:10" if "imb" in c else c for c in schemas.FEATURES)


@register(
    "feature_vector",
    table(
        "(SELECT product_id, as_of_ts, "
        + ", ".join(
            f"coalesce(CAST({c} AS DOUBLE), CAST('nan' AS DOUBLE)) AS {c}" for c in schemas.FEATURES
        )
        + " FROM gold)",
        "product_id as_of_ts",
        _VECTOR,
        "gold",
    ),
)
def _(spark, d):
    return shape(
        modelling.feature_vector(V.gold_rows(spark, d)),
        "product_id as_of_ts",
        _VECTOR,
    )


@register("products", query("SELECT DISTINCT product_id FROM gold ORDER BY 1", "gold"))
def _(spark, d):
    return modelling.products(V.gold_rows(spark, d))


@register(
    "enough_rows",
    query("SELECT count(*) >= 60 AS enough FROM train", "train"),
)
def _(spark, d):
    enough = modelling.enough_rows(_train(spark, d), BARS)
    return spark.range(1).select(F.lit(enough).alias("enough"))


# --- predictions -----------------------------------------------------------


def _preds(spark, d):
    forecast = (F.col("rv_5m") + F.col("rv_60m")) / F.lit(2.0)
    return predictions.prediction_rows(
        V.gold_rows(spark, d), forecast, F.lit("mean-v1"), BARS
    )


def _labeled(spark, d):
    return predictions.label_join(_preds(spark, d), V.gold_rows(spark, d), BARS)


_PRED = ("product_id as_of_ts label_ts model_version", "pred_rv pred_persistence")


@register("predictions", table("preds", *_PRED, "preds"))
def _(spark, d):
    return shape(_preds(spark, d), *_PRED)


@register(
    "predictions_insert_new",
    table(f"preds WHERE as_of_ts >= TIMESTAMP '{_HALF}'", *_PRED, "preds"),
)
def _(spark, d):
    rows = _preds(spark, d)
    existing = rows.where(F.col("as_of_ts") < F.lit(_HALF).cast("timestamp_ntz"))
    return shape(predictions.only_new(rows, existing), *_PRED)


@register(
    "label_join", table("labeled", "product_id as_of_ts", "pred_rv label_rv", "labeled")
)
def _(spark, d):
    return shape(_labeled(spark, d), "product_id as_of_ts", "pred_rv label_rv")


_ERRORS = """
count(*) AS n_labeled, avg(abs(pred_rv - label_rv)) AS model_mae,
sqrt(avg(power(pred_rv - label_rv, 2))) AS model_rmse,
avg(abs(pred_persistence - label_rv)) AS persistence_mae,
sqrt(avg(power(pred_persistence - label_rv, 2))) AS persistence_rmse
"""
_RECENT = f"label_rv IS NOT NULL AND as_of_ts > TIMESTAMP '{NOW}' - INTERVAL 10 DAY"


@register(
    "accuracy",
    table(
        f"""(SELECT *, 1 - model_mae / nullif(persistence_mae, 0) AS skill_vs_persistence FROM
             (SELECT product_id, {_ERRORS} FROM labeled WHERE {_RECENT} GROUP BY 1))""",
        "product_id n_labeled",
        "model_mae model_rmse persistence_mae persistence_rmse skill_vs_persistence",
        "labeled",
    ),
)
def _(spark, d):
    rows = predictions.accuracy(_labeled(spark, d), now(), minutes=10 * 24 * 60)
    return shape(
        rows,
        "product_id n_labeled",
        "model_mae model_rmse persistence_mae persistence_rmse skill_vs_persistence",
    )


@register(
    "labeled_recent",
    table(f"labeled WHERE {_RECENT}", "product_id as_of_ts", "label_rv", "labeled"),
)
def _(spark, d):
    rows = predictions.labeled_since(_labeled(spark, d), now(), minutes=10 * 24 * 60)
    return shape(rows, "product_id as_of_ts", "label_rv")


@register(
    "rolling_mae",
    table(
        """(SELECT *, 1 - model_mae / nullif(persistence_mae, 0) AS skill_vs_persistence FROM
             (SELECT product_id, as_of_ts, avg(abs(pred_rv - label_rv)) OVER w AS model_mae,
                     avg(abs(pred_persistence - label_rv)) OVER w AS persistence_mae
              FROM labeled WHERE label_rv IS NOT NULL
              WINDOW w AS (PARTITION BY product_id ORDER BY as_of_ts
                           RANGE BETWEEN INTERVAL 59 HOUR PRECEDING AND CURRENT ROW)))""",
        "product_id as_of_ts",
        "model_mae persistence_mae skill_vs_persistence",
        "labeled",
    ),
)
def _(spark, d):
    return shape(
        predictions.rolling_accuracy(_labeled(spark, d), 60, BARS),
        "product_id as_of_ts",
        "model_mae persistence_mae skill_vs_persistence",
    )


@register(
    "hourly_counts",
    query(
        """SELECT product_id, date_trunc('day', as_of_ts) AS hour_ts, count(*) AS predictions,
                  count(label_rv) AS labels FROM labeled GROUP BY 1, 2""",
        "labeled",
    ),
)
def _(spark, d):
    return predictions.hourly_counts(_labeled(spark, d), "1 day")


@register(
    "trailing_counts",
    query(
        """SELECT product_id, as_of_ts, count(*) OVER w AS predictions, count(label_rv) OVER w AS labels
           FROM labeled WINDOW w AS (PARTITION BY product_id ORDER BY as_of_ts
             RANGE BETWEEN INTERVAL 86399999999 MICROSECONDS PRECEDING AND CURRENT ROW)""",
        "labeled",
    ),
)
def _(spark, d):
    return predictions.trailing_counts(_labeled(spark, d), 86_400)


@register(
    "latest_prediction",
    table(
        """(SELECT product_id, max(as_of_ts) AS as_of_ts, arg_max(pred_rv, as_of_ts) AS pred_rv
            FROM preds GROUP BY 1)""",
        "product_id as_of_ts",
        "pred_rv",
        "preds",
    ),
)
def _(spark, d):
    return shape(
        predictions.latest_per_product(_preds(spark, d)), "product_id as_of_ts", "pred_rv"
    )


@register(
    "latest_features",
    table(
        """(SELECT * FROM gold QUALIFY row_number()
            OVER (PARTITION BY product_id ORDER BY as_of_ts DESC) = 1)""",
        *_GOLD,
        "gold",
    ),
)
def _(spark, d):
    return shape(predictions.latest_per_product(V.gold_rows(spark, d)), *_GOLD)


@register(
    "publish_features",
    table(
        f"gold WHERE as_of_ts > TIMESTAMP '{NOW}' - INTERVAL 2 HOUR",
        "product_id as_of_ts bar_count_5m",
        "rv_5m",
        "gold",
    ),
)
def _(spark, d):
    kept = predictions.recent_history(V.gold_rows(spark, d), now(), FEED.history_ttl_seconds)
    return shape(kept, "product_id as_of_ts bar_count_5m", "rv_5m")


# --- operations ------------------------------------------------------------


@register(
    "latency_p95",
    query(
        """SELECT date_trunc('day', ts) AS window_ts, count(*) AS n,
                  quantile_disc(value, 0.95) AS latency_q FROM events GROUP BY 1""",
    ).replace("WITH \n", ""),
)
def _(spark, d):
    return monitor.latency_quantile(V.events(spark, d), "ts", "value", per="1 day")


@register(
    "latency_histogram",
    """WITH b AS (
         SELECT date_trunc('day', ts) AS window_ts,
                CASE WHEN value > 0 THEN CAST(ceil(ln(value) / ln(1.01 / 0.99)) AS BIGINT) END AS bucket
         FROM events
       ), h AS (
         SELECT window_ts, bucket, count(*) AS n FROM b GROUP BY 1, 2
       ), c AS (
         SELECT window_ts, bucket, sum(n) OVER (PARTITION BY window_ts ORDER BY bucket NULLS FIRST) AS upto,
                sum(n) OVER (PARTITION BY window_ts) AS n FROM h
       )
       SELECT window_ts, CAST(max(n) AS BIGINT) AS n,
              round(CASE WHEN min(coalesce(bucket, -1000000)) = -1000000 THEN 0
                    ELSE 2 / (1.01 / 0.99 + 1) * power(1.01 / 0.99, min(bucket)) END, 6) AS latency_q
       FROM c WHERE upto >= ceil(0.95 * n) GROUP BY 1""",
)
def _(spark, d):
    found = monitor.latency_histogram(V.events(spark, d), "ts", "value", per="1 day")
    return shape(monitor.histogram_quantile(found), "window_ts n", "latency_q")


@register(
    "counter_increase",
    query(
        """SELECT product_id, event_id, total,
                  CAST(sum(rise) OVER (PARTITION BY product_id ORDER BY ts
                    RANGE BETWEEN INTERVAL 3599999999 MICROSECONDS PRECEDING AND CURRENT ROW) AS BIGINT)
                    AS increase
           FROM (SELECT *, CASE WHEN before IS NULL THEN 0 WHEN total < before THEN total
                                ELSE total - before END AS rise
                 FROM (SELECT *, lag(total) OVER (PARTITION BY product_id ORDER BY event_id) AS before
                       FROM (SELECT product_id, event_id, ts, row_number() OVER (
                               PARTITION BY product_id, epoch ORDER BY event_id) AS total FROM e)))""",
        "e",
    ),
)
def _(spark, d):
    # Messages so far on a connection: the counter starts anew with each one.
    w = W.partitionBy("product_id", "epoch").orderBy("event_id")
    samples = V.events(spark, d).withColumn("total", F.row_number().over(w).cast("long"))
    found = monitor.increase(samples, "product_id", "ts", "total", "event_id", 3600, FEED)
    return found.select("product_id", "event_id", "total", "increase")


@register(
    "consumer_lag",
    """WITH parts AS (SELECT event_type AS topic, user_id % 3 AS part, max(event_id) AS max_offset,
                             min(event_id) AS committed FROM events GROUP BY 1, 2)
       SELECT 'grp-' || part AS "group", CAST(sum(max_offset - committed) AS BIGINT) AS lag
       FROM parts GROUP BY 1""",
)
def _(spark, d):
    part = (F.col("user_id") % 3).alias("partition")
    offsets = V.events(spark, d).groupBy(F.col("product_id").alias("topic"), part)
    latest = offsets.agg(F.max("event_id").alias("max_offset"))
    committed = offsets.agg(F.min("event_id").alias("committed")).withColumn(
        "group", F.concat(F.lit("grp-"), F.col("partition").cast("string"))
    )
    return monitor.consumer_lag(latest, committed)


@register(
    "sample_rows",
    table(
        """(SELECT * FROM gold ORDER BY md5('7|' || product_id || '|'
              || CAST(epoch_us(as_of_ts) AS VARCHAR)) LIMIT 3)""",
        "product_id as_of_ts",
        "rv_5m",
        "gold",
    ),
)
def _(spark, d):
    key = F.concat_ws("|", "product_id", micros("as_of_ts").cast("string"))
    return shape(
        monitor.sample_rows(V.gold_rows(spark, d), 3, key, seed=7),
        "product_id as_of_ts",
        "rv_5m",
    )


@register(
    "minute_ready",
    query(
        """SELECT DISTINCT product_id, date_trunc('hour', bar_ts) AS as_of_ts FROM book_bars
           WHERE least((SELECT max(bar_ts) FROM book_bars), (SELECT max(bar_ts) FROM trade_bars))
                 >= date_trunc('hour', bar_ts) + INTERVAL 2 SECOND""",
        "book_bars",
        "trade_bars",
    ),
)
def _(spark, d):
    books = V.book_bars(spark, d)
    tagged = bars.tagged_bars(books, V.trade_bars(spark, d))
    return monitor.ready_points(books, tagged, BARS, FEED)
