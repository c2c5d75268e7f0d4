"""Data-quality checks as ordinary queries, plus the gates built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow import schemas
from tickflow.functions.clock import shift
from tickflow.operators.gaps import gap_report
from tickflow.spec import BarSpec, FeedSpec


class QualityError(ValueError):
    """A hard gate failed."""


def gold_quality(gold_rows: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """One row: duplicate keys, misaligned labels, low-coverage rows.

    Duplicates are counted from per-key counts, which combine before the
    shuffle; a global distinct count would not.
    """
    bad_label = ~F.col("label_ts").eqNullSafe(shift("as_of_ts", spec.label_seconds))
    low = (F.col("bar_count_5m") < spec.serve_coverage) | (
        F.col("label_bar_count") < spec.serve_coverage
    )
    per_key = gold_rows.groupBy("product_id", "as_of_ts").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(bad_label).alias("bad"),
        F.count_if(low).alias("low"),
    )
    return per_key.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad_label_ts"),
        F.coalesce(F.sum("low"), F.lit(0)).alias("low_coverage"),
    )


def require_gold_quality(gold_rows: DataFrame, spec: BarSpec = BarSpec()) -> int:
    """Raise on duplicates or misaligned labels; return the low-coverage count."""
    row = gold_quality(gold_rows, spec).first()
    if row.duplicates or row.bad_label_ts:
        raise QualityError(
            f"gold corrupt: duplicates={row.duplicates} bad_label_ts={row.bad_label_ts}"
        )
    return row.low_coverage


def gold_ranges(gold_rows: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """Smallest coverage, volatility and spread slack, and whether they will do."""
    low = spec.serve_coverage
    passed = (
        (F.col("min_bar_count") >= low)
        & (F.col("min_label_bar_count") >= low)
        & (F.col("min_rv_5m") >= 0)
        & (F.col("min_spread_slack") >= 0)
    )
    return gold_rows.agg(
        F.min("bar_count_5m").alias("min_bar_count"),
        F.min("label_bar_count").alias("min_label_bar_count"),
        F.min("rv_5m").alias("min_rv_5m"),
        F.min(F.col("spread_max_5m") - F.col("spread_mean_5m")).alias("min_spread_slack"),
    ).withColumn("passed", passed)


def close(a: Column, b: Column, rel: float, floor: float) -> Column:
    """Equal within tolerance; NULL only equals NULL."""
    bound = F.greatest(F.lit(rel) * F.greatest(F.abs(a), F.abs(b)), F.lit(floor))
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(
        F.abs(a - b) <= bound
    )


def parity(
    online: DataFrame,
    offline: DataFrame,
    columns: Sequence[str] = schemas.FEATURES,
    rel: float = 1e-7,
    floor: float = 1e-12,
) -> DataFrame:
    """Matched online/offline rows with the number of columns that disagree."""
    a, b = online.alias("a"), offline.alias("b")
    keys = ["product_id", "as_of_ts"]
    wrong = [
        F.when(close(F.col(f"a.{c}").cast("double"), F.col(f"b.{c}").cast("double"), rel, floor), 0)
        .otherwise(1)
        for c in columns
    ]
    return a.join(b, keys).select(*keys, sum(wrong[1:], wrong[0]).alias("mismatches"))


def point_in_time(rechecked: DataFrame, rel: float = 1e-9) -> DataFrame:
    """Per product: rows, and rows whose features or label cannot be re-derived."""
    past_ok = close(F.col("rv_5m"), F.col("past_rv"), rel, 1e-12)
    future_ok = close(F.col("label_rv_5m"), F.col("future_rv"), rel, 1e-12)
    return rechecked.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~past_ok).alias("leaky_features"),
        F.count_if(~future_ok).alias("leaky_labels"),
    )


def feed_gate(
    trade_rows: DataFrame, dead: DataFrame, spec: FeedSpec = FeedSpec()
) -> DataFrame:
    """One row: products, gaps, missed ids, dead letters, and the verdict."""
    totals = gap_report(trade_rows, spec).agg(
        F.count(F.lit(1)).alias("products"),
        F.coalesce(F.sum("gaps"), F.lit(0)).alias("gaps"),
        F.coalesce(F.sum("missed"), F.lit(0)).alias("missed"),
    )
    letters = dead.agg(F.count(F.lit(1)).alias("dead_letters"))
    both = totals.withColumn("dead_letters", letters.scalar())
    ok = (F.col("products") > 0) & (F.col("gaps") == 0) & (F.col("dead_letters") == 0)
    return both.withColumn("passed", ok)
