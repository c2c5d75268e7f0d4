"""Scoring, the delayed label join, and live accuracy.

Predictions and labels are separate append-only tables joined on read; nothing
is updated in place. ``now`` is always a parameter.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickflow import schemas
from tickflow.functions.clock import shift, step_ceil
from tickflow.functions.flow import skill
from tickflow.operators.gold import chunk_of
from tickflow.operators.modelling import tree_inputs
from tickflow.operators.ordered import trailing_sums
from tickflow.spec import BarSpec

KEYS = ["product_id", "as_of_ts"]


def prediction_rows(
    features: DataFrame, forecast: Column, version: Column, spec: BarSpec = BarSpec()
) -> DataFrame:
    """One prediction per well-covered feature row, inputs kept as JSON."""
    payload = [c for c in (*schemas.FEATURES, "bar_count_5m") if c in features.columns]
    return features.where(F.col("bar_count_5m") >= spec.serve_coverage).select(
        *KEYS,
        shift("as_of_ts", spec.label_seconds).alias("label_ts"),
        forecast.alias("pred_rv"),
        F.col("rv_5m").alias("pred_persistence"),
        version.alias("model_version"),
        F.to_json(F.struct(*payload)).alias("features"),
    )


def score(
    features: DataFrame, model: PipelineModel, version: str, spec: BarSpec = BarSpec()
) -> DataFrame:
    """Predictions of a fitted tree model; works on batches and streams alike."""
    scored = model.transform(tree_inputs(features.withColumn("_raw", F.struct(*features.columns))))
    raw = scored.select("_raw.*", "trees")
    return prediction_rows(raw, F.col("trees"), F.lit(version), spec)


def only_new(rows: DataFrame, existing: DataFrame, order: Column | None = None) -> DataFrame:
    """Rows whose key is not in the target yet, one for each key: the first write wins.

    Of rows with one key that arrive together the first one by ``order`` counts, such as
    their arrival number; without an order, the least one by its columns.
    """
    rest = [c for c in rows.columns if c not in KEYS]
    if not rest:
        return rows.distinct().join(existing.select(*KEYS), KEYS, "left_anti")
    row = F.struct(*rest)
    first = F.min(row) if order is None else F.min_by(row, F.struct(order, row))
    one = rows.groupBy(*KEYS).agg(first.alias("_row")).select(*KEYS, "_row.*").select(*rows.columns)
    return one.join(existing.select(*KEYS), KEYS, "left_anti")


def label_join(
    predictions: DataFrame, features: DataFrame, spec: BarSpec = BarSpec()
) -> DataFrame:
    """Realised volatility of a prediction at T is rv_5m of the row at T + label.

    Labels come from every feature row, also from poorly covered ones. A row that was
    delivered twice labels once.
    """
    labels = features.groupBy(
        "product_id", shift("as_of_ts", -spec.label_seconds).alias("as_of_ts")
    ).agg(F.min("rv_5m").alias("label_rv"))
    return predictions.join(labels, KEYS, "left")


def new_labels(
    predictions: DataFrame,
    features: DataFrame,
    known: DataFrame,
    now: Column,
    spec: BarSpec = BarSpec(),
) -> DataFrame:
    """Labels that are due and not in ``known`` yet: (product_id, as_of_ts, label_rv, labeled_at).

    The first label of a prediction wins; later feature rows for its time change nothing.
    """
    due = label_join(predictions.select(*KEYS).distinct(), features, spec)
    fresh = due.where("label_rv IS NOT NULL").join(known.select(*KEYS), KEYS, "left_anti")
    return fresh.select(*KEYS, "label_rv", now.alias("labeled_at"))


def with_labels(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Predictions with the label that the log has, if any, and when it was known."""
    return predictions.join(labels.select(*KEYS, "label_rv", "labeled_at"), KEYS, "left")


def trailing_counts(labeled: DataFrame, seconds: int = 3600) -> DataFrame:
    """Per prediction: predictions and labels of its product in the trailing window."""
    one = {"predictions": F.lit(1).cast("long"), "labels": F.col("label_rv").isNotNull().cast("long")}
    rows = labeled.select(*KEYS, "label_rv")
    chunk = max(seconds, 86_400)
    return trailing_sums(rows, "product_id", "as_of_ts", one, seconds, chunk).drop("label_rv")


def labeled_since(labeled: DataFrame, now: Column, minutes: int) -> DataFrame:
    """Labelled predictions of the trailing window."""
    return labeled.where(
        F.col("label_rv").isNotNull() & (F.col("as_of_ts") > shift(now, -60 * minutes))
    )


def _error_columns() -> list[Column]:
    model = F.col("pred_rv") - F.col("label_rv")
    naive = F.col("pred_persistence") - F.col("label_rv")
    return [
        F.count(F.lit(1)).alias("n_labeled"),
        F.avg(F.abs(model)).alias("model_mae"),
        F.sqrt(F.avg(model * model)).alias("model_rmse"),
        F.avg(F.abs(naive)).alias("persistence_mae"),
        F.sqrt(F.avg(naive * naive)).alias("persistence_rmse"),
    ]


def accuracy(labeled: DataFrame, now: Column, minutes: int = 60) -> DataFrame:
    """Model and persistence errors per product over the trailing window."""
    return (
        labeled_since(labeled, now, minutes)
        .groupBy("product_id")
        .agg(*_error_columns())
        .withColumn("skill_vs_persistence", skill(F.col("model_mae"), F.col("persistence_mae")))
    )


def rolling_accuracy(
    labeled: DataFrame, steps: int = 60, spec: BarSpec = BarSpec()
) -> DataFrame:
    """The same errors as a series: at every prediction over its last ``steps``.

    Rows are copied into every later chunk that their window reaches, so a long
    history of one product is spread over tasks.
    """
    step = step_ceil("as_of_ts", spec.step_us)
    rows = labeled.where(F.col("label_rv").isNotNull()).withColumn("step", step)
    home = chunk_of(F.col("step"), spec)
    reach = F.sequence(home, chunk_of(F.col("step") + steps - 1, spec))
    spread = rows.withColumn("home", home).withColumn("chunk", F.explode(reach))
    w = W.partitionBy("product_id", "chunk").orderBy("step").rangeBetween(-(steps - 1), 0)
    model = F.abs(F.col("pred_rv") - F.col("label_rv"))
    naive = F.abs(F.col("pred_persistence") - F.col("label_rv"))
    return (
        spread.select(
            *KEYS,
            "home",
            "chunk",
            F.avg(model).over(w).alias("model_mae"),
            F.avg(naive).over(w).alias("persistence_mae"),
        )
        .where(F.col("home") == F.col("chunk"))
        .select(
            *KEYS,
            "model_mae",
            "persistence_mae",
            skill(F.col("model_mae"), F.col("persistence_mae")).alias("skill_vs_persistence"),
        )
    )


def hourly_counts(labeled: DataFrame, bucket: str = "1 hour") -> DataFrame:
    """Predictions written and labels joined, per product and hour."""
    return (
        labeled.groupBy("product_id", F.window("as_of_ts", bucket))
        .agg(F.count(F.lit(1)).alias("predictions"), F.count("label_rv").alias("labels"))
        .select(
            "product_id",
            F.col("window.start").cast("timestamp_ntz").alias("hour_ts"),
            "predictions",
            "labels",
        )
    )


def latest_per_product(rows: DataFrame) -> DataFrame:
    """The newest row of every product, as one partial-aggregating pass."""
    rest = [c for c in rows.columns if c not in ("product_id", "as_of_ts")]
    # Column by column: fixed-width buffers keep this a hash aggregate.
    return rows.groupBy("product_id").agg(
        F.max("as_of_ts").alias("as_of_ts"), *[F.max_by(c, "as_of_ts").alias(c) for c in rest]
    )


def recent_history(rows: DataFrame, now: Column, ttl_seconds: int) -> DataFrame:
    """Feature history that has not expired."""
    return rows.where(F.col("as_of_ts") > shift(now, -ttl_seconds))


