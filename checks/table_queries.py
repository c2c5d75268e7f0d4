"""Tables, refresh, models and parity: operators that write or fit first."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import views as V
from checks.queries import _GOLD, _HALF, _TB, _preds, _train, now, register, shape
from checks.sql import query, table
from checks.stream_queries import _ONLINE, _ONLINE_COLUMNS
from checks.views import BARS, FEED
from tickflow import schemas
from tickflow.functions.clock import step_time
from tickflow.operators import gold, modelling, predictions, quality
from tickflow.operators.modelling import TreeSpec
from tickflow.plans import landing, refresh, scoring, training
from tickflow.plans.scoring import online_rows
from tickflow.session import scratch_path
from tickflow.sinks import topics
from tickflow.sinks.tables import VersionedTable, write_partitioned

_DAY = "bar_date"


def _trade_table(spark, d) -> VersionedTable:
    """A published bar table."""
    stored = refresh.trade_bar_table(scratch_path(spark, "trade-bars"))
    stored.publish(V.trade_bars(spark, d))
    return stored


def _book_table(spark, d) -> VersionedTable:
    stored = refresh.book_bar_table(scratch_path(spark, "book-bars"))
    stored.publish(V.book_bars(spark, d))
    return stored


@register(
    "partitioned_write",
    table("(SELECT *, CAST(bar_ts AS DATE) AS bar_date FROM trade_bars)",
          _TB[0] + " bar_date", _TB[1], "trade_bars"),
)
def _(spark, d):
    path = scratch_path(spark, "trade-bars")
    write_partitioned(V.trade_bars(spark, d), path, "bar_ts", _DAY)
    stored = spark.read.schema(schemas.with_day(schemas.TRADE_BAR, _DAY)).parquet(path)
    return shape(stored, _TB[0] + " bar_date", _TB[1])


@register("compact_table", table("trade_bars", *_TB, "trade_bars"))
def _(spark, d):
    # Every third minute comes later, but for the first days: those keep their files.
    rows = V.trade_bars(spark, d)
    late = (F.minute("bar_ts") % 3 == 0) & (F.dayofmonth("bar_ts") > 9)
    stored = refresh.trade_bar_table(scratch_path(spark, "trade-bars"))
    stored.publish(rows.where(~late))
    stored.append(rows.where(late))
    stored.compact(spark)
    return shape(stored.read(spark), *_TB)


@register(
    "retain_versions",
    query("SELECT CAST(v AS BIGINT) AS version, n FROM (SELECT unnest([2, 3]) AS v), "
          "(SELECT count(*) AS n FROM trade_bars)", "trade_bars"),
)
def _(spark, d):
    stored = _trade_table(spark, d)
    for _ in range(2):
        stored.publish(stored.read(spark).drop("bar_date"))
    stored.retain(spark, keep=2)
    whole = spark.read.schema(T.StructType([*stored.schema.fields, T.StructField("version", T.LongType())])).parquet(stored.root)
    return whole.groupBy("version").agg(F.count(F.lit(1)).alias("n"))


@register(
    "reset_tables",
    query("SELECT 0 AS rows_after, count(*) AS rows_before FROM trade_bars", "trade_bars"),
)
def _(spark, d):
    stored = _trade_table(spark, d)
    before = stored.read(spark).agg(F.count(F.lit(1)).alias("rows_before"))
    stored.reset(spark)
    after = stored.read(spark).agg(F.count(F.lit(1)).cast("int").alias("rows_after"))
    return before.withColumn("rows_after", after.scalar())


@register(
    "keyed_topic",
    query(
        """SELECT 'bars.trade' AS topic, product_id AS key, count(*) AS n,
                  CAST(sum(trade_count) AS BIGINT) AS trades FROM trade_bars GROUP BY 2""",
        "trade_bars",
    ),
)
def _(spark, d):
    path = scratch_path(spark, "topic")
    records = topics.limited(topics.keyed(V.trade_bars(spark, d), "bars.trade"))
    topics.write_files(records, path, 0)
    sent = spark.read.schema("key string, value string, topic string").json(f"{path}/batch_id=0")
    count = F.get_json_object("value", "$.trade_count").cast("long")
    return sent.groupBy("topic", "key").agg(
        F.count(F.lit(1)).alias("n"), F.sum(count).alias("trades")
    )


@register(
    "landed_feed",
    query(
        """SELECT 'book' AS route, count(*) AS n FROM snapshot_text WHERE strlen(value_text) <= 260
           UNION ALL SELECT 'dlq', (SELECT count(*) FROM texts WHERE route = 'dlq')
             + (SELECT count(*) FROM snapshot_text WHERE strlen(value_text) > 260)
           UNION ALL SELECT route, count(*) FROM texts
             WHERE route IN ('trades', 'heartbeat') GROUP BY 1""",
        "snapshot_text",
        "texts",
    ),
)
def _(spark, d):
    done = landing.land(V.feed(spark, d), FEED)
    parts = {
        "trades": done.trades,
        "book": done.books,
        "heartbeat": done.heartbeats,
        "dlq": done.dead,
    }
    counts = [
        df.agg(F.lit(name).alias("route"), F.count(F.lit(1)).alias("n"))
        for name, df in parts.items()
    ]
    return counts[0].union(counts[1]).union(counts[2]).union(counts[3])


@register("gold_refresh", table("gold", *_GOLD, "gold"))
def _(spark, d):
    # Two refreshes: bars up to mid-month, then the rest; the sum is one build.
    book, trade = _book_table(spark, d), _trade_table(spark, d)
    target = refresh.gold_table(scratch_path(spark, "gold"))
    half = F.lit(_HALF).cast("timestamp_ntz")
    early_book = book.read(spark).where(F.col("bar_ts") <= half)
    early_trade = trade.read(spark).where(F.col("bar_ts") <= half)
    target.publish(gold.gold(early_book, early_trade, BARS, built_at=now()))
    refresh.refresh(spark, book, trade, target, BARS, built_at=now())
    return shape(target.read(spark), *_GOLD)


@register(
    "build_report",
    query("SELECT 0 AS rows_before, count(*) AS rows_added, count(*) AS rows_total FROM gold",
          "gold"),
)
def _(spark, d):
    target = refresh.gold_table(scratch_path(spark, "gold"))
    made = refresh.refresh(
        spark, _book_table(spark, d), _trade_table(spark, d), target, BARS, built_at=now()
    )
    return target.read(spark).agg(
        F.lit(made.rows_before).cast("int").alias("rows_before"),
        F.lit(made.rows_added).cast("long").alias("rows_added"),
        F.count(F.lit(1)).alias("rows_total"),
    )


@register(
    "build_progress",
    query(
        """SELECT g.product_id, g.next_ts, b.bars_to, b.base_ts, round(b.base_mid, 6) AS base_mid, g.rows
           FROM (SELECT product_id, max(as_of_ts) + INTERVAL 1 HOUR AS next_ts, count(*) AS rows
                 FROM gold GROUP BY product_id) g
           JOIN (SELECT p.product_id, max(p.bar_ts) AS bars_to,
                        max(p.bar_ts) FILTER (WHERE p.bar_ts <= n.lo) AS base_ts,
                        max_by(p.mid_close, p.bar_ts) FILTER (WHERE p.bar_ts <= n.lo) AS base_mid
                 FROM book_bars p JOIN (SELECT product_id, max(as_of_ts) - INTERVAL 59 HOUR AS lo
                                        FROM gold GROUP BY product_id) n
                   ON n.product_id = p.product_id GROUP BY p.product_id) b
             ON b.product_id = g.product_id""",
        "gold",
        "book_bars",
    ),
)
def _(spark, d):
    # Built in two parts; the progress is what the second one committed.
    book, trade = _book_table(spark, d), _trade_table(spark, d)
    target = refresh.gold_table(scratch_path(spark, "gold"))
    half = F.lit(_HALF).cast("timestamp_ntz")
    early = [t.read(spark).where(F.col("bar_ts") <= half) for t in (book, trade)]
    target.publish(gold.gold(*early, BARS, built_at=now()))
    refresh.refresh(spark, book, trade, target, BARS, built_at=now())
    return refresh.progress_table(target).read(spark).select(
        "product_id",
        step_time("next_step", BARS.step_us).alias("next_ts"),
        "bars_to",
        "base_ts",
        F.round("base_mid", 6).alias("base_mid"),
        "rows",
    )


@register(
    "label_log",
    query(
        f"""SELECT product_id, as_of_ts, round(label_rv, 9) AS label_rv,
                   CASE WHEN as_of_ts + INTERVAL 5 HOUR <= TIMESTAMP '{_HALF}'
                        THEN TIMESTAMP '2024-01-16 00:00:00' ELSE TIMESTAMP '{V.NOW}' END AS labeled_at
            FROM labeled WHERE label_rv IS NOT NULL""",
        "labeled",
    ),
)
def _(spark, d):
    # Features come in two parts, the first one twice; each label is written once.
    made, rows = _preds(spark, d), V.gold_rows(spark, d)
    store = scoring.label_table(scratch_path(spark, "labels"))
    half = F.col("as_of_ts") <= F.lit(_HALF).cast("timestamp_ntz")
    early = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    for part, at in ((rows.where(half), early), (rows.where(half), now()), (rows.where(~half), now())):
        scoring.label_new(spark, made, part, store, at, BARS)
    return shape(store.read(spark), "product_id as_of_ts labeled_at", "label_rv:9")


@register(
    "latest_labeled",
    table(
        f"""(SELECT product_id, max(as_of_ts) AS as_of_ts, arg_max(pred_rv, as_of_ts) AS pred_rv,
                    arg_max(label_rv, as_of_ts) AS label_rv
             FROM labeled WHERE label_rv IS NOT NULL AND as_of_ts + INTERVAL 5 HOUR <= TIMESTAMP '{_HALF}'
             GROUP BY 1)""",
        "product_id as_of_ts",
        "pred_rv label_rv",
        "labeled",
    ),
)
def _(spark, d):
    # The newest prediction that the log has a label for, with it.
    made, rows = _preds(spark, d), V.gold_rows(spark, d)
    store = scoring.label_table(scratch_path(spark, "labels"))
    early = rows.where(F.col("as_of_ts") <= F.lit(_HALF).cast("timestamp_ntz"))
    scoring.label_new(spark, made, early, store, now(), BARS)
    known = predictions.with_labels(made, store.read(spark)).where("label_rv IS NOT NULL")
    newest = predictions.latest_per_product(known.select("product_id", "as_of_ts", "pred_rv", "label_rv"))
    return shape(newest, "product_id as_of_ts", "pred_rv label_rv")


# --- online features in batch, and their parity with gold ------------------


@register("online_features", table(_ONLINE, *_ONLINE_COLUMNS, "rets", "trade_bars"))
def _(spark, d):
    rows = online_rows(V.book_bars(spark, d), V.trade_bars(spark, d), BARS, FEED)
    return shape(rows, *_ONLINE_COLUMNS)


@register(
    "parity",
    query(
        f"""SELECT g.product_id, g.as_of_ts, 0 AS mismatches
            FROM gold g JOIN {_ONLINE} o
              ON o.product_id = g.product_id AND o.as_of_ts = g.as_of_ts""",
        "gold",
        "rets",
        "trade_bars",
    ),
)
def _(spark, d):
    online = online_rows(V.book_bars(spark, d), V.trade_bars(spark, d), BARS, FEED)
    return quality.parity(online, V.gold_rows(spark, d))


# --- fitted models ---------------------------------------------------------

# The operator's own ensemble; every boosting round is a distributed job of its own.
TREES = TreeSpec()


def _registry(spark):
    return spark.createDataFrame([], "version string")


def _run(spark, d) -> training.Run:
    return training.train(V.gold_rows(spark, d), _registry(spark), BARS, TREES)


def _har(spark, d):
    rows = modelling.prepare(V.gold_rows(spark, d), BARS)
    fit, test, _ = modelling.time_split(rows, BARS)
    scored = modelling.fit_har(fit).transform(modelling.har_inputs(test))
    return modelling.with_persistence(scored)


@register(
    "har_predictions",
    table(
        "(SELECT product_id, as_of_ts, har, y AS label_rv_5m FROM har WHERE test)",
        "product_id as_of_ts",
        "har label_rv_5m",
        "har",
    ),
)
def _(spark, d):
    return shape(_har(spark, d), "product_id as_of_ts", "har label_rv_5m")


_HAR_METRICS = " UNION ALL ".join(
    f"SELECT '{m}' AS model, product_id, count(*) AS n, avg(abs(y - {m})) AS mae, "
    f"sqrt(avg((y - {m}) * (y - {m}))) AS rmse FROM har WHERE test "
    "GROUP BY GROUPING SETS ((), (product_id))"
    for m in ("persistence", "har")
)


@register("har_eval", table(f"({_HAR_METRICS})", "model product_id n", "mae rmse", "har"))
def _(spark, d):
    metrics = modelling.evaluate(_har(spark, d), ["persistence", "har"])
    return shape(metrics, "model product_id n", "mae rmse")


@register("gbt_scores")
def _(spark, d):
    rows = modelling.prepare(V.gold_rows(spark, d), BARS)
    fit, test, _ = modelling.time_split(rows, BARS)
    scored = modelling.fit_trees(fit, TREES).transform(modelling.tree_inputs(test))
    return shape(scored, "product_id as_of_ts", "trees label_rv_5m")


@register("model_eval")
def _(spark, d):
    return shape(_run(spark, d).metrics, "model product_id n", "mae rmse")


@register("feature_importance")
def _(spark, d):
    rows = modelling.prepare(V.gold_rows(spark, d), BARS)
    return modelling.importances(modelling.fit_trees(rows, TREES), spark)


@register("run_record")
def _(spark, d):
    return _run(spark, d).record


_SKILLS = """
(SELECT 'har' AS model, 1 - avg(abs(label_rv_5m - (rv_5m + rv_60m) / 2))
                            / avg(abs(label_rv_5m - rv_5m)) AS skill
 FROM train, cut WHERE as_of_ts >= cut)
"""


@register(
    "promotion",
    query(
        f"""SELECT model, round(skill, 6) AS skill,
                  CASE WHEN skill >= 0 THEN 'promoted' ELSE 'rejected' END AS status,
                  'skill_gate' AS reason, CASE WHEN skill >= 0 THEN 11 END AS version
           FROM {_SKILLS}""",
        "train",
        "cut",
    ).replace("THEN 11 END", "THEN CAST(11 AS BIGINT) END"),
)
def _(spark, d):
    # The mean of two lags stands in for a fitted model; versions 2 and 10 serve.
    test = modelling.with_persistence(modelling.time_split(_train(spark, d), BARS)[1])
    scored = test.withColumn("har", (F.col("rv_5m") + F.col("rv_60m")) / F.lit(2.0))
    skills = modelling.model_skill(modelling.evaluate(scored, ["persistence", "har"]))
    versions = spark.createDataFrame([("2",), ("10",)], "version string")
    decided = modelling.promotion(skills, versions, "har", BARS)
    return shape(decided, "model status reason version", "skill")


