"""Chunked ordered operators equal plain windows, whatever the chunking."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickflow.operators import monitor, ordered
from tickflow.spec import FeedSpec


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = [
        (rng.choice("abc"), i, rng.choice([None, rng.randint(-50, 50)]), rng.random() < 0.1)
        for i in range(600)
    ]
    return spark.createDataFrame(data, "key string, seq long, v long, mark boolean")


@pytest.mark.parametrize("size", [1, 7, 64, 10_000])
def test_equal_to_plain_windows(rows, size):
    got = ordered.over_chunks(
        ordered.arrival_chunk(rows, size, "seq"),
        "key",
        "seq",
        "chunk",
        [
            ordered.previous("v", "prev", "seq"),
            ordered.running_max("v", "top"),
            ordered.running_max("v", "top_here", inclusive=True),
            ordered.running_sum("v", "total"),
            ordered.running_last("v", F.col("mark"), "marked", "seq"),
            ordered.running_last("v", F.col("v").isNull(), "void", "seq"),
        ],
    ).drop("chunk")
    w = W.partitionBy("key").orderBy("seq")
    past = w.rowsBetween(W.unboundedPreceding, -1)
    here = w.rowsBetween(W.unboundedPreceding, 0)
    boxed = F.when(F.col("mark"), F.struct("v"))
    want = rows.select(
        "*",
        F.lag("v").over(w).alias("prev"),
        F.max("v").over(past).alias("top"),
        F.max("v").over(here).alias("top_here"),
        F.coalesce(F.sum("v").over(here), F.lit(0)).alias("total"),
        F.last(boxed, ignorenulls=True).over(here)["v"].alias("marked"),
        F.lit(None).cast("long").alias("void"),
    )
    got = got.select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_bulk_is_shuffled_once_by_chunk(rows):
    """No join: the carried values enter the window as rows."""
    df = ordered.over_chunks(
        ordered.arrival_chunk(rows, 64, "seq"),
        "key",
        "seq",
        "chunk",
        [ordered.running_max("v", "top")],
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    # One exchange for the rows; the per-chunk summary has its own two.
    assert plan.count("Exchange hashpartitioning") == 3 and "Join" not in plan


def stamped(spark, rows, schema):
    start = datetime(2024, 3, 5, 23, 59, 0)
    return spark.createDataFrame([(*r[:-1], start + timedelta(seconds=r[-1])) for r in rows], schema)


def test_trailing_sums_are_half_open_and_cross_chunks(spark):
    rng = random.Random(4)
    rows = [("A" if rng.random() < 0.8 else "B", rng.randint(1, 9), i, rng.randint(0, 400)) for i in range(300)]
    df = stamped(spark, rows, "k string, v int, i long, at timestamp_ntz")
    for chunk in (60, 100, 3600):
        got = ordered.trailing_sums(df, "k", "at", {"s": F.col("v")}, 60, chunk).collect()
        want = {i: sum(v2 for k2, v2, _, t2 in rows if k2 == k and t - 60 < t2 <= t) for k, _, i, t in rows}
        assert {r.i: r.s for r in got} == want
    with pytest.raises(ValueError, match="at least as long"):
        ordered.trailing_sums(df, "k", "at", {"s": F.col("v")}, 60, 59)


def test_increase_of_a_counter_that_starts_anew(spark):
    rows = [("A", 0, 5, 0), ("A", 1, 9, 10), ("A", 2, 2, 20), ("A", 3, 2, 30), ("A", 4, 7, 95), ("B", 5, 100, 96)]
    df = stamped(spark, rows, "k string, i long, total long, at timestamp_ntz")
    for chunk_rows in (1, 2, 100):
        got = monitor.increase(df, "k", "at", "total", "i", 60, FeedSpec(chunk_rows=chunk_rows)).collect()
        # Rises: 0, 4, 2 (anew), 0, 5; B has one sample.
        assert {r.i: r.increase for r in got} == {0: 0, 1: 4, 2: 6, 3: 6, 4: 5, 5: 0}


def test_histogram_quantile_is_within_its_error_and_merges(spark):
    rng = random.Random(6)
    values = [rng.lognormvariate(0, 2) for _ in range(3000)] + [0.0, -1.0]
    rows = [(v, i % 400) for i, v in enumerate(values)]
    df = stamped(spark, rows, "v double, at timestamp_ntz")
    for error in (0.01, 0.1):
        whole = monitor.latency_histogram(df, "at", "v", "1 day", error)
        parts = [monitor.latency_histogram(df.where(f"v {c} 1"), "at", "v", "1 day", error) for c in ("<", ">=")]
        exact = {r.window_ts: r.latency_q for r in monitor.latency_quantile(df, "at", "v", per="1 day").collect()}
        for hist in (whole, parts[0].unionByName(parts[1])):
            got = monitor.histogram_quantile(hist, 0.95, error).collect()
            assert {r.window_ts for r in got} == set(exact) and len(exact) == 2
            assert all(abs(r.latency_q - exact[r.window_ts]) <= 1.0001 * error * exact[r.window_ts] for r in got)
        assert whole.count() < 2 * 16 / error
    low = monitor.histogram_quantile(monitor.latency_histogram(df.where("v <= 0"), "at", "v", "1 day"), 0.5)
    assert {r.latency_q for r in low.collect()} == {0.0}
