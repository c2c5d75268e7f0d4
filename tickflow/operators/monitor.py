"""Operational measures over message, latency and offset tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickflow.functions.clock import shift, step_floor, step_time
from tickflow.operators.bars import stream_marks
from tickflow.operators.ordered import arrival_chunk, over_chunks, previous, trailing_sums
from tickflow.spec import BarSpec, FeedSpec


def message_rate(routed: DataFrame, clock: str, per: str = "1 minute") -> DataFrame:
    """Messages per second by route, in tumbling windows."""
    start, end = F.col("window.start"), F.col("window.end")
    span = (F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))).cast(
        "double"
    )
    return (
        routed.groupBy(F.window(clock, per), "route")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            start.cast("timestamp_ntz").alias("window_ts"),
            "route",
            "n",
            (F.col("n") / span).alias("per_second"),
        )
    )


def feed_counters(routed: DataFrame, running: DataFrame) -> DataFrame:
    """(kind, n): messages per route, missed trade ids, and reconnects.

    Every connection opens with one control message; the first is no reconnect.
    """
    routes = routed.groupBy(F.col("route").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    missed = running.agg(
        F.lit("trade_gaps").alias("kind"), F.coalesce(F.sum("missed"), F.lit(0)).alias("n")
    )
    opened = F.count_if(F.col("route") == "control")
    again = routed.agg(
        F.lit("reconnects").alias("kind"), F.greatest(opened - 1, F.lit(0)).alias("n")
    )
    return routes.where("kind <> 'control'").unionByName(missed).unionByName(again)


def latency_quantile(
    latencies: DataFrame, clock: str, value: str, q: float = 0.95, per: str = "10 minutes"
) -> DataFrame:
    """Exact latency quantile per tumbling window, from mergeable counts of its values."""
    return (
        latencies.groupBy(F.window(clock, per))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {value})").alias("latency_q"),
        )
        .select(F.col("window.start").cast("timestamp_ntz").alias("window_ts"), "n", "latency_q")
    )


def latency_histogram(
    latencies: DataFrame,
    clock: str,
    value: str,
    per: str = "10 minutes",
    relative_error: float = 0.01,
) -> DataFrame:
    """(window_ts, bucket, n): counts of latencies in buckets of a constant ratio.

    Bucket b holds values in (g^(b-1), g^b] with g = (1 + e) / (1 - e), so a window has
    about ln(largest / least) / 2e rows however many values it has; values of zero or
    less, and those that are no numbers, are in the bucket NULL. Histograms merge by
    summing ``n``: of parts of a window, of windows, of streams.
    """
    log = float(math.log((1 + relative_error) / (1 - relative_error)))
    bucket = F.when(F.col(value) > 0, F.ceil(F.ln(F.col(value)) / F.lit(log)))
    return (
        latencies.groupBy(F.window(clock, per), bucket.cast("long").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").cast("timestamp_ntz").alias("window_ts"), "bucket", "n")
    )


def histogram_quantile(
    histogram: DataFrame, q: float = 0.95, relative_error: float = 0.01
) -> DataFrame:
    """A quantile per window, within ``relative_error`` of the value at its rank."""
    ratio = (1 + relative_error) / (1 - relative_error)
    merged = histogram.groupBy("window_ts", "bucket").agg(F.sum("n").alias("n"))
    order = W.partitionBy("window_ts").orderBy(F.col("bucket").asc_nulls_first())
    upto = F.sum("n").over(order.rowsBetween(W.unboundedPreceding, 0))
    whole = F.sum("n").over(W.partitionBy("window_ts"))
    found = merged.withColumns({"_upto": upto, "_n": whole})
    # The first bucket that reaches the rank; its middle in ratio, or zero.
    found = found.where(F.col("_upto") >= F.ceil(F.lit(q) * F.col("_n")))
    first = found.groupBy("window_ts").agg(
        F.max("_n").alias("n"), F.min(F.coalesce("bucket", F.lit(-(2**62)))).alias("_bucket")
    )
    middle = F.lit(2.0 / (ratio + 1)) * F.pow(F.lit(ratio), F.col("_bucket"))
    value = F.when(F.col("_bucket") == -(2**62), F.lit(0.0)).otherwise(middle)
    return first.select("window_ts", "n", value.alias("latency_q"))


def increase(
    samples: DataFrame,
    key: str,
    clock: str,
    total: str,
    order: str,
    seconds: int,
    spec: FeedSpec = FeedSpec(),
) -> DataFrame:
    """Add ``increase``: how much a counter rose in each sample's trailing window.

    A counter that falls has started anew, so the whole new value counts. A key's first
    sample adds nothing. ``order`` numbers the samples; ties of the clock count together.
    """
    chunked = arrival_chunk(samples, spec.chunk_rows, order)
    linked = over_chunks(chunked, key, order, "chunk", [previous(total, "_before", order)])
    rise = F.when(F.col("_before").isNull(), F.lit(0)).otherwise(
        F.when(F.col(total) < F.col("_before"), F.col(total)).otherwise(
            F.col(total) - F.col("_before")
        )
    )
    rows = linked.withColumn("_rise", rise).drop("chunk")
    return trailing_sums(
        rows, key, clock, {"increase": F.col("_rise")}, seconds, max(seconds, 86_400)
    ).drop("_before", "_rise")


def consumer_lag(latest: DataFrame, committed: DataFrame) -> DataFrame:
    """Messages a consumer group is behind, summed over partitions."""
    joined = committed.join(latest, ["topic", "partition"])
    return joined.groupBy("group").agg(
        F.sum(F.col("max_offset") - F.col("committed")).alias("lag")
    )


def sample_rows(rows: DataFrame, n: int, key: Column, seed: int = 0) -> DataFrame:
    """n rows in a seeded pseudo-random order that any engine can repeat."""
    return rows.withColumn(
        "_draw", F.md5(F.concat_ws("|", F.lit(str(seed)), key))
    ).orderBy("_draw").limit(n).drop("_draw")


def first_letters(dead: DataFrame, n: int = 5) -> DataFrame:
    """The first dead letters, for a report."""
    return dead.orderBy("arrival_seq").limit(n)


def ready_points(
    book_bars: DataFrame, tagged: DataFrame, spec: BarSpec = BarSpec(), feed: FeedSpec = FeedSpec()
) -> DataFrame:
    """Grid points that both streams have passed by the safety margin.

    Without both streams nothing is ready.
    """
    both = stream_marks(tagged).agg(
        F.when(F.count(F.lit(1)) == 2, F.min("high_water")).alias("both")
    )
    point = step_time(step_floor("bar_ts", spec.step_us), spec.step_us)
    return (
        book_bars.select("product_id", point.alias("as_of_ts"))
        .distinct()
        .where(shift("as_of_ts", feed.sync_margin_seconds) <= both.scalar())
    )
