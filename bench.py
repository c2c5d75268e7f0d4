"""Time the headline jobs; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Inputs that a deployment keeps as tables (raw messages, landed messages, bars)
are written before the clock starts; each time is the better of two runs.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from checks import views as V  # noqa: E402
from checks.views import BARS, FEED  # noqa: E402
from tickflow.operators import bars, book, gaps, gold, quality, router  # noqa: E402
from tickflow.plans import refresh  # noqa: E402
from tickflow.session import local_session, materialize, scratch_path  # noqa: E402


def run(df) -> None:
    """Compute every row and column, keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def range_join(books, trades):
    """Features by joining every bar with every grid point it serves: the plan
    that the per-step partial sums replace, timed for comparison."""
    rets = gold.log_returns(books, BARS).drop("chunk", "step").alias("r")
    points = gold.grid(gold.pending_bounds(gold.grid_bounds(books, BARS), None, BARS)).select(
        "product_id", gold.step_time("step", BARS.step_us).alias("t")
    )
    near = (
        (F.col("r.product_id") == F.col("g.product_id"))
        & (F.col("r.bar_ts") > F.col("g.t") - F.expr("INTERVAL 60 HOURS"))
        & (F.col("r.bar_ts") <= F.col("g.t") + F.expr("INTERVAL 5 HOURS"))
    )
    ret2 = F.col("r.ret") * F.col("r.ret")
    past = F.col("r.bar_ts") <= F.col("g.t")

    def within(hours: int):
        return past & (F.col("r.bar_ts") > F.col("g.t") - F.expr(f"INTERVAL {hours} HOURS"))

    return points.alias("g").join(rets, near).groupBy("g.product_id", "g.t").agg(
        *[F.sqrt(F.sum(F.when(within(h), ret2))).alias(f"rv_{h}m") for h in BARS.horizons],
        F.sum(F.when(within(5), F.col("r.ofi_sum"))).alias("ofi_5m"),
        F.avg(F.when(within(5), F.col("r.spread_mean"))).alias("spread_mean_5m"),
        F.max(F.when(within(5), F.col("r.spread_max"))).alias("spread_max_5m"),
        F.sqrt(F.sum(F.when(~past, ret2))).alias("label_rv_5m"),
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))

    feed = materialize(V.feed(spark, sf_dir), "bench-feed")
    routed = router.route(feed)
    landed_trades = materialize(router.trades(routed), "bench-trades")
    landed_beats = materialize(router.heartbeats(routed), "bench-beats")
    landed_books = materialize(router.book_messages(routed), "bench-books")
    tops = materialize(V.quotes(spark, sf_dir), "bench-tops")
    matched = materialize(V.matches(spark, sf_dir), "bench-matches")
    book_table = refresh.book_bar_table(scratch_path(spark, "bench-book-bars"))
    trade_table = refresh.trade_bar_table(scratch_path(spark, "bench-trade-bars"))
    book_table.publish(bars.book_bars(tops, BARS))
    trade_table.publish(bars.trade_bars(matched, BARS))
    books, trades = book_table.read(spark), trade_table.read(spark)
    built = materialize(gold.gold(books, trades, BARS), "bench-gold")
    half = built.where(F.col("as_of_ts") <= F.lit("2024-01-28 00:00:00").cast("timestamp_ntz"))
    progress = materialize(refresh.scanned_progress(books, half, BARS), "bench-progress")

    jobs = {
        "route_feed": lambda: run(routed.drop("msg")),
        "trade_bars": lambda: run(bars.trade_bars(matched, BARS)),
        "book_bars": lambda: run(bars.book_bars(tops, BARS)),
        "book_tops": lambda: run(book.book_tops(landed_books, FEED)),
        "trade_gaps": lambda: run(gaps.running_gaps(landed_trades, landed_beats, FEED)),
        "gold": lambda: run(gold.gold(books, trades, BARS)),
        "gold_incremental": lambda: run(refresh.pending(books, trades, progress, spec=BARS).rows(BARS)),
        "gold_quality": lambda: quality.require_gold_quality(built, BARS),
    }
    compared = {"gold_range_join": lambda: run(range_join(books, trades))}
    seconds: dict[str, float] = {}
    for name, job in {**jobs, **compared}.items():
        best = None
        for _ in range(2):
            start = time.perf_counter()
            job()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline_jobs_total",
                "value": round(sum(seconds[n] for n in jobs), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
