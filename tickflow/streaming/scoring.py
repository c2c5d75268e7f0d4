"""Scoring and labelling of a live stream of feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.operators import predictions
from tickflow.spec import BarSpec

KEYS = ["product_id", "as_of_ts"]


def once(features: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Each (product, as_of_ts) once, however often it is delivered."""
    return features.withWatermark("as_of_ts", delay).dropDuplicatesWithinWatermark(KEYS)


def score(
    features: DataFrame, forecast: Column, version: Column, spec: BarSpec = BarSpec(),
    delay: str = "10 minutes",
) -> DataFrame:
    """Predictions of every well-covered feature row, once per key."""
    return predictions.prediction_rows(once(features, delay), forecast, version, spec)


def labels(
    scored: DataFrame, features: DataFrame, spec: BarSpec = BarSpec(), delay: str = "10 minutes"
) -> DataFrame:
    """Realised volatility of predictions, as soon as its feature row arrives.

    ``scored`` needs as_of_ts, label_ts and a watermark on one of them; both
    sides keep state only while the other can still match.
    """
    realised = features.select(
        F.col("product_id").alias("of_product"),
        F.col("as_of_ts").alias("realised_ts"),
        F.col("rv_5m").alias("label_rv"),
    ).withWatermark("realised_ts", delay)
    due = scored.withWatermark("as_of_ts", delay)
    wait = F.make_dt_interval(secs=F.lit(spec.label_seconds))
    meet = (
        (F.col("product_id") == F.col("of_product"))
        & (F.col("realised_ts") == F.col("as_of_ts") + wait)
    )
    return due.join(realised, meet).select(
        *KEYS, "pred_rv", "pred_persistence", "label_rv", F.col("realised_ts").alias("labeled_ts")
    )


