"""Point-in-time features and the forward label on a regular time grid.

Window edges lie on grid points and windows are half-open ``(t - H, t]``. Every
bar therefore belongs to exactly one grid step, bars collapse to one partial
aggregate per (product, step), and each feature is a ``rangeBetween`` over step
numbers. Book partials, trade partials and grid points travel as one tagged
union, so the whole table needs a single window pass and no join.

Long histories are cut into chunks of steps. A partial is copied into the next
(previous) chunk when windows there reach back (forward) to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickflow import schemas
from tickflow.functions.clock import floor_div, micros, shift, step_ceil, step_time
from tickflow.functions.flow import imbalance
from tickflow.operators.ordered import over_chunks, previous
from tickflow.spec import BarSpec

# Partial sums per step: name -> (kind, where it comes from).
_BOOK_SUMS = {
    "ret2": "ret2",
    "ofi": "ofi_sum",
    "spread_sum": "spread_mean",
    "bid_sum": "bid_depth5_mean",
    "ask_sum": "ask_depth5_mean",
}
_BOOK_COUNTS = {
    "spread_n": "spread_mean",
    "bid_n": "bid_depth5_mean",
    "ask_n": "ask_depth5_mean",
}
_TRADE_SUMS = {
    "trades": "trade_count",
    "volume": "volume",
    "notional": "notional",
    "maker_buy": "maker_buy_volume",
    "maker_sell": "maker_sell_volume",
}


def chunk_of(step: Column, spec: BarSpec) -> Column:
    return floor_div(step, spec.chunk_steps)


def log_returns(bars: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """ret = ln(mid / previous bar's mid) over a product's whole series.

    Returns bridge outages and window edges; the very first bar has none.
    """
    stepped = bars.withColumn("step", step_ceil("bar_ts", spec.step_us))
    stepped = stepped.withColumn("chunk", chunk_of(F.col("step"), spec))
    linked = over_chunks(
        stepped, "product_id", "bar_ts", "chunk", [previous("mid_close", "prev_mid", "bar_ts")]
    )
    usable = (F.col("mid_close") > 0) & (F.col("prev_mid") > 0)
    return linked.withColumn("ret", F.when(usable, F.ln(F.col("mid_close") / F.col("prev_mid"))))


def book_partials(bars: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """One row per (product, step) from book bars.

    Steps are nested in the chunks of the return pass, so grouping by both
    keeps the partitioning and needs no further shuffle.
    """
    rets = log_returns(bars, spec).withColumn("ret2", F.col("ret") * F.col("ret"))
    return (
        rets.groupBy("product_id", "chunk", "step")
        .agg(
            *[F.sum(src).alias(name) for name, src in _BOOK_SUMS.items()],
            *[F.count(src).alias(name) for name, src in _BOOK_COUNTS.items()],
            F.max("spread_max").alias("spread_max"),
            F.count(F.lit(1)).alias("bars"),
        )
        .drop("chunk")
    )


def trade_partials(bars: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    return bars.groupBy("product_id", step_ceil("bar_ts", spec.step_us).alias("step")).agg(
        *[F.sum(src).alias(name) for name, src in _TRADE_SUMS.items()]
    )


def grid_bounds(bars: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """First and last grid point with full history and a complete label window."""
    us = F.lit(spec.step_us)
    return bars.groupBy("product_id").agg(
        (floor_div(micros(F.min("bar_ts")), spec.step_us) + spec.history + 1).alias("start_step"),
        (floor_div(micros(F.max("bar_ts")), spec.step_us) - spec.label_horizon).alias("end_step"),
    ).withColumns(
        {
            "start_ts": step_time(F.col("start_step"), spec.step_us),
            "end_ts": step_time(F.col("end_step"), spec.step_us),
        }
    )


def high_water(gold_rows: DataFrame) -> DataFrame:
    """The newest grid point already built, per product."""
    return gold_rows.groupBy("product_id").agg(F.max("as_of_ts").alias("high_water"))


def pending_bounds(
    bounds: DataFrame, built: DataFrame | None, spec: BarSpec = BarSpec()
) -> DataFrame:
    """Bounds that start after what is already built; finished products drop out."""
    if built is None:
        return bounds.where(F.col("start_step") <= F.col("end_step"))
    after = step_ceil(F.col("high_water"), spec.step_us) + 1
    return (
        bounds.join(built, "product_id", "left")
        .withColumn("start_step", F.greatest("start_step", after))
        .withColumn("start_ts", step_time(F.col("start_step"), spec.step_us))
        .drop("high_water")
        .where(F.col("start_step") <= F.col("end_step"))
    )


def grid(bounds: DataFrame) -> DataFrame:
    """Every grid point between the bounds: (product_id, step)."""
    return bounds.select(
        "product_id", F.explode(F.sequence("start_step", "end_step")).alias("step")
    )


def features(
    book: DataFrame, trade: DataFrame, points: DataFrame, spec: BarSpec = BarSpec()
) -> DataFrame:
    """Window sums at every grid point from partials of both streams."""
    rows = book.unionByName(trade, allowMissingColumns=True)
    # Windows at t use steps (t - history, t + label], seen from the partial:
    reach = F.array_distinct(
        F.array(
            chunk_of(F.col("step") - spec.label_horizon, spec),
            chunk_of(F.col("step"), spec),
            chunk_of(F.col("step") + spec.history - 1, spec),
        )
    )
    rows = rows.withColumns({"chunk": F.explode(reach), "is_point": F.lit(False)})
    marks = points.withColumns(
        {"chunk": chunk_of(F.col("step"), spec), "is_point": F.lit(True)}
    )
    every = rows.unionByName(marks, allowMissingColumns=True)

    order = W.partitionBy("product_id", "chunk").orderBy("step")

    def trailing(steps: int):
        return order.rangeBetween(-(steps - 1), 0)

    flow = trailing(spec.flow_horizon)
    ahead = order.rangeBetween(1, spec.label_horizon)
    near = order.rangeBetween(-(spec.history - 1), spec.label_horizon)

    def mean(total: str, n: str) -> Column:
        return F.sum(total).over(flow) / F.nullif(F.sum(n).over(flow), F.lit(0))

    wide = every.select(
        "product_id",
        "step",
        "is_point",
        F.sum("bars").over(near).alias("near_bars"),
        *[F.sqrt(F.sum("ret2").over(trailing(h))).alias(f"rv_{h}m") for h in spec.horizons],
        F.sum("ofi").over(flow).alias("ofi_5m"),
        mean("spread_sum", "spread_n").alias("spread_mean_5m"),
        F.max("spread_max").over(flow).alias("spread_max_5m"),
        mean("bid_sum", "bid_n").alias("bid_depth_5m"),
        mean("ask_sum", "ask_n").alias("ask_depth_5m"),
        *[F.sum(name).over(flow).alias(f"{name}_5m") for name in _TRADE_SUMS],
        F.coalesce(F.sum("bars").over(flow), F.lit(0)).alias("bar_count_5m"),
        F.sqrt(F.sum("ret2").over(ahead)).alias("label_rv_5m"),
        F.coalesce(F.sum("bars").over(ahead), F.lit(0)).alias("label_bar_count"),
    )
    return wide.where("is_point AND near_bars > 0").drop("is_point", "near_bars")


def gold(
    book_bars: DataFrame,
    trade_bars: DataFrame,
    spec: BarSpec = BarSpec(),
    built: DataFrame | None = None,
    bounds: DataFrame | None = None,
    built_at: Column | None = None,
) -> DataFrame:
    """Feature and label rows for every grid point not built yet.

    ``built`` is the high-water table of an earlier build. ``bounds`` may be
    passed when ``book_bars`` was already cut down to what new rows need.
    """
    if bounds is None:
        bounds = grid_bounds(book_bars, spec)
    points = grid(pending_bounds(bounds, built, spec))
    wide = features(
        book_partials(book_bars, spec), trade_partials(trade_bars, spec), points, spec
    )
    as_of = step_time(F.col("step"), spec.step_us)
    zero = F.lit(0.0)
    return wide.select(
        "product_id",
        as_of.alias("as_of_ts"),
        step_time(F.col("step") + spec.label_horizon, spec.step_us).alias("label_ts"),
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
        "label_rv_5m",
        F.col("label_bar_count").cast("long").alias("label_bar_count"),
        (F.localtimestamp() if built_at is None else built_at).alias("built_at"),
    )


def recheck(
    gold_rows: DataFrame, book_bars: DataFrame, spec: BarSpec = BarSpec()
) -> DataFrame:
    """Re-derive rv_5m and the label from bars strictly on one side of as_of.

    Independent of the step sums above: bars are linked to the grid points they
    serve by an equi-join on the step, and each side is checked on its own.
    """
    rets = log_returns(book_bars, spec).select("product_id", "bar_ts", "step", "ret")
    offsets = F.sequence(F.lit(-spec.label_horizon), F.lit(spec.flow_horizon - 1))
    spread_out = rets.withColumn("off", F.explode(offsets)).select(
        "product_id", "bar_ts", "ret", (F.col("step") + F.col("off")).alias("point")
    )
    keyed = gold_rows.select(
        "product_id",
        "as_of_ts",
        "rv_5m",
        "label_rv_5m",
        step_ceil("as_of_ts", spec.step_us).alias("point"),
    )
    past = F.col("bar_ts") <= F.col("as_of_ts")
    ret2 = F.col("ret") * F.col("ret")
    return (
        keyed.join(spread_out, ["product_id", "point"], "left")
        .groupBy("product_id", "as_of_ts")
        .agg(
            F.first("rv_5m").alias("rv_5m"),
            F.first("label_rv_5m").alias("label_rv_5m"),
            F.sqrt(F.sum(F.when(past, ret2))).alias("past_rv"),
            F.sqrt(F.sum(F.when(~past, ret2))).alias("future_rv"),
        )
    )
