"""Online scoring: due feature rows, predictions, labels, accuracy."""

from __future__ import annotations

from datetime import timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow import schemas
from tickflow.functions.clock import step_ceil, step_time
from tickflow.functions.flow import imbalance
from tickflow.operators import bars, gold, monitor, predictions
from tickflow.sinks import topics
from tickflow.session import materialize
from tickflow.sinks.tables import VersionedTable
from tickflow.spec import BarSpec, FeedSpec


def online_rows(
    book_bars: DataFrame,
    trade_bars: DataFrame,
    spec: BarSpec = BarSpec(),
    feed: FeedSpec = FeedSpec(),
) -> DataFrame:
    """Batch form of the online features: all points both streams have passed.

    Same partial sums as gold, asked at other points: no start-up period, no
    wait for a label, and no row without a usable return.
    """
    tagged = bars.tagged_bars(book_bars, trade_bars)
    points = monitor.ready_points(book_bars, tagged, spec, feed).select(
        "product_id", step_ceil("as_of_ts", spec.step_us).alias("step")
    )
    wide = gold.features(
        gold.book_partials(book_bars, spec), gold.trade_partials(trade_bars, spec), points, spec
    )
    zero = F.lit(0.0)
    return wide.where(
        (F.col("bar_count_5m") > 0) & (F.col(f"rv_{spec.history}m") > 0)
    ).select(
        "product_id",
        step_time("step", spec.step_us).alias("as_of_ts"),
        *[f"rv_{h}m" for h in spec.horizons],
        "ofi_5m",
        "spread_mean_5m",
        "spread_max_5m",
        imbalance(
            F.col("bid_depth_5m"),
            F.col("ask_depth_5m"),
            F.col("bid_depth_5m") + F.col("ask_depth_5m"),
        ).alias("depth_imb_5m"),
        F.coalesce("trades_5m", F.lit(0)).cast("long").alias("trade_count_5m"),
        F.coalesce("volume_5m", zero).alias("volume_5m"),
        F.coalesce("notional_5m", zero).alias("notional_5m"),
        imbalance(F.col("maker_sell_5m"), F.col("maker_buy_5m"), F.col("volume_5m")).alias(
            "taker_imb_5m"
        ),
        F.col("bar_count_5m").cast("long").alias("bar_count_5m"),
    )


def prediction_table(root: str) -> VersionedTable:
    return VersionedTable(root, schemas.with_day(schemas.PREDICTION, "as_of_date"), "as_of_ts",
                          "as_of_date")


def on_days_of(table: DataFrame, features: DataFrame) -> DataFrame:
    """Rows of a day-partitioned table in the span of the features' clock, as a pruned scan."""
    span = features.agg(F.min("as_of_ts").alias("lo"), F.max("as_of_ts").alias("hi")).first()
    if span.lo is None:
        return table.limit(0)
    lo, hi = (F.lit(t).cast("timestamp_ntz").cast("date") for t in (span.lo, span.hi))
    return table.where((F.col("as_of_date") >= lo) & (F.col("as_of_date") <= hi))


def score_new(
    spark: SparkSession,
    features: DataFrame,
    model: PipelineModel,
    version: str,
    target: VersionedTable,
    created_at,
    spec: BarSpec = BarSpec(),
) -> DataFrame:
    """Score rows that have no prediction yet, append them, return their records.

    Only days of the target that the features fall on are opened. Running it again with
    the same features adds nothing.
    """
    rows = predictions.score(features, model, version, spec).withColumn(
        "created_at", created_at
    )
    known = on_days_of(target.read(spark), features)
    new = materialize(predictions.only_new(rows, known), "predictions")
    target.append(new)
    return topics.keyed(new.drop("features", "created_at"), "predictions")


def label_table(root: str) -> VersionedTable:
    schema = schemas.with_day(schemas.LABEL_ROW, "as_of_date")
    return VersionedTable(root, schema, "as_of_ts", "as_of_date")


def label_new(
    spark: SparkSession,
    made: DataFrame,
    features: DataFrame,
    store: VersionedTable,
    now: Column,
    spec: BarSpec = BarSpec(),
) -> DataFrame:
    """Append the labels that ``features`` make known, and return them.

    ``features`` are the rows that came in since, such as a day's. Of predictions and of
    the label log only days that they can label are opened, so a run costs what is new;
    running it again adds nothing.
    """
    span = features.agg(F.min("as_of_ts").alias("lo"), F.max("as_of_ts").alias("hi")).first()
    if span.lo is None:
        return spark.createDataFrame([], schemas.LABEL_ROW)
    ahead = timedelta(seconds=spec.label_seconds)

    def reached(rows: DataFrame) -> DataFrame:
        lo, hi = (F.lit(t - ahead).cast("timestamp_ntz") for t in (span.lo, span.hi))
        rows = rows.where((F.col("as_of_ts") >= lo) & (F.col("as_of_ts") <= hi))
        if "as_of_date" in rows.columns:
            day = F.col("as_of_date")
            rows = rows.where((day >= lo.cast("date")) & (day <= hi.cast("date")))
        return rows

    fresh = predictions.new_labels(reached(made), features, reached(store.read(spark)), now, spec)
    new = materialize(fresh, "labels")
    store.append(new)
    return new
