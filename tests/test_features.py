"""Window edges, point-in-time correctness and incremental builds of features."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickflow import schemas
from tickflow.operators import gold, quality
from tickflow.plans import refresh
from tickflow.plans.scoring import online_rows
from tickflow.session import scratch_path
from tickflow.spec import BarSpec

T0 = datetime(2024, 3, 5, 9, 0, 0)


def built():
    return F.lit("2024-03-06 00:00:00").cast("timestamp_ntz")


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def book_bar(ts, mid, spread=1.0, top=1.0, bid=10.0, ask=5.0, ofi=1.0, product="P"):
    return (product, ts, mid, mid, mid, spread, top, bid, ask, ofi, 1, 1)


def trade_bar(ts, n=1, volume=1.0, buy=0.0, sell=1.0, product="P"):
    return (product, ts, n, volume, volume * 100, buy, sell, 1.0, 1.0)


def frames(spark, books, trades=()):
    return (
        spark.createDataFrame(list(books), schemas.BOOK_BAR),
        spark.createDataFrame(list(trades), schemas.TRADE_BAR),
    )


def row_at(spark, books, trades, ts, spec=BarSpec()):
    """Features of one grid point, whatever the usual bounds."""
    book, trade = frames(spark, books, trades)
    points = spark.createDataFrame(
        [("P", int((ts - datetime(1970, 1, 1)).total_seconds()) // spec.step_seconds)],
        "product_id string, step long",
    )
    wide = gold.features(
        gold.book_partials(book, spec), gold.trade_partials(trade, spec), points, spec
    )
    return wide.first()


def test_windows_are_half_open_and_reach_back_for_the_base(spark):
    mids = {-300: 80.0, -90: 84.0, -60: 82.0, -7: 83.5, 0: 81.0}
    r = row_at(spark, [book_bar(at(s), m) for s, m in mids.items()], [], T0)
    moves = [math.log(b / a) ** 2 for a, b in zip(list(mids.values()), list(mids.values())[1:])]
    assert math.isclose(r.rv_1m, math.sqrt(sum(moves[2:])), rel_tol=1e-12)
    for name in ("rv_5m", "rv_15m", "rv_60m"):
        assert math.isclose(r[name], math.sqrt(sum(moves)), rel_tol=1e-12)
    # The bar exactly five minutes back is outside, the one at the point inside.
    assert (r.bar_count_5m, r.ofi_5m) == (4, 4.0)


def test_the_future_stays_out(spark):
    books = [book_bar(at(s), m) for s, m in ((-20, 64.0), (0, 48.0), (1, 7.0), (2, 21.0))]
    r = row_at(spark, books, [], T0)
    assert math.isclose(r.rv_1m, math.log(64 / 48)) and r.bar_count_5m == 2
    ahead = math.hypot(math.log(48 / 7), math.log(21 / 7))
    assert math.isclose(r.label_rv_5m, ahead) and r.label_bar_count == 2


def test_spreads_and_depths(spark):
    bars = [(0.25, 0.75), (0.5, 8.0), (1.5, 2.0), (0.75, 2.0)]
    books = [
        book_bar(at(-40 + k), 50.0, mean, widest, bid=4.0 + k, ask=12.0)
        for k, (mean, widest) in enumerate(bars)
    ]
    r = row_at(spark, books, [], T0)
    assert (r.spread_mean_5m, r.spread_max_5m) == (0.75, 8.0)
    assert (r.bid_depth_5m, r.ask_depth_5m) == (5.5, 12.0)


def test_trades_count_only_inside_the_window(spark):
    trades = [
        trade_bar(at(-299), 3, 5.0, 4.0, 1.0),
        trade_bar(at(0), 4, 3.0, 0.0, 3.0),
        trade_bar(at(-301), 50, 50.0),
        trade_bar(at(1), 50, 50.0),
    ]
    r = row_at(spark, [book_bar(at(-2), 50.0)], trades, T0)
    assert (r.trades_5m, r.volume_5m) == (7, 8.0)
    assert (r.maker_sell_5m - r.maker_buy_5m) / r.volume_5m == 0.0


def test_first_bar_counts_but_has_no_return(spark):
    r = row_at(spark, [book_bar(at(-1), 100.0)], [], T0)
    assert r.rv_5m is None and r.bar_count_5m == 1 and r.label_bar_count == 0


def test_no_bar_in_reach_no_row(spark):
    assert row_at(spark, [book_bar(at(-3600), 100.0)], [], T0) is None
    assert row_at(spark, [book_bar(at(301), 100.0)], [], T0) is None
    assert row_at(spark, [book_bar(at(300), 100.0)], [], T0) is not None


def test_horizons_must_be_whole_steps():
    with pytest.raises(ValueError):
        BarSpec(horizons=(1, 2.5))
    with pytest.raises(ValueError):
        BarSpec(chunk_steps=30)


def market(seed, minutes=200, products=("A", "B")):
    """Random second bars with holes and a six-minute outage."""
    rng = random.Random(seed)
    books, trades = [], []
    for p in products:
        mid = 100.0
        for s in range(minutes * 60):
            if rng.random() < 0.7 or 4000 < s < 4360:
                continue
            mid *= math.exp(rng.gauss(0, 1e-4))
            books.append(book_bar(at(s), mid, rng.random(), rng.random() + 1,
                                  float(rng.randint(1, 9)), float(rng.randint(1, 9)),
                                  rng.gauss(0, 1), p))
            if rng.random() < 0.3:
                buy, sell = rng.random(), rng.random()
                trades.append(trade_bar(at(s), rng.randint(1, 5), buy + sell, buy, sell, p))
    return books, trades


SMALL = BarSpec(chunk_steps=70)


@pytest.fixture(scope="module")
def bars(spark):
    book, trade = frames(spark, *market(3))
    return book.cache(), trade.cache()


def test_chunking_does_not_matter(bars):
    one = gold.gold(*bars, BarSpec(), built_at=built()).collect()
    many = gold.gold(*bars, SMALL, built_at=built()).collect()
    key = lambda r: (r.product_id, r.as_of_ts)
    assert len(one) == 2 * (200 - 1 - 5 - 61 + 1)
    for a, b in zip(sorted(one, key=key), sorted(many, key=key), strict=True):
        assert key(a) == key(b)
        for x, y in zip(a, b):
            same = x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-9))
            assert same, (key(a), x, y)


def test_rows_can_be_rederived_from_one_side_of_time(bars):
    rows = gold.gold(*bars, SMALL, built_at=built())
    verdict = quality.point_in_time(gold.recheck(rows, bars[0], SMALL)).collect()
    assert all(r.leaky_features == 0 and r.leaky_labels == 0 and r.rows > 0 for r in verdict)


def test_quality_gate(bars):
    rows = gold.gold(*bars, SMALL, built_at=built())
    low = quality.require_gold_quality(rows, SMALL)
    assert low == rows.count()  # holes everywhere: reported, not fatal
    with pytest.raises(quality.QualityError, match="duplicates=1"):
        quality.require_gold_quality(rows.unionByName(rows.limit(1)), SMALL)
    moved = rows.withColumn("label_ts", F.col("as_of_ts"))
    with pytest.raises(quality.QualityError, match="bad_label_ts"):
        quality.require_gold_quality(moved, SMALL)


def test_online_rows_agree_with_gold(bars):
    online = online_rows(*bars, SMALL)
    verdict = quality.parity(online, gold.gold(*bars, SMALL, built_at=built())).agg(
        F.count(F.lit(1)).alias("n"), F.sum("mismatches").alias("bad")
    ).first()
    assert verdict.n > 200 and verdict.bad == 0


def test_refresh_is_incremental_and_idempotent(spark, bars):
    book = refresh.book_bar_table(scratch_path(spark, "t-book"))
    trade = refresh.trade_bar_table(scratch_path(spark, "t-trade"))
    target = refresh.gold_table(scratch_path(spark, "t-gold"))
    early = F.lit(at(110 * 60)).cast("timestamp_ntz")
    book.publish(bars[0].where(F.col("bar_ts") <= early))
    trade.publish(bars[1].where(F.col("bar_ts") <= early))
    first = refresh.refresh(spark, book, trade, target, SMALL, built())
    assert first.rows_before == 0 and first.rows_added > 0
    book.append(bars[0].where(F.col("bar_ts") > early))
    trade.append(bars[1].where(F.col("bar_ts") > early))
    second = refresh.refresh(spark, book, trade, target, SMALL, built())
    assert second.rows_added > 0
    assert refresh.refresh(spark, book, trade, target, SMALL, built()).rows_added == 0
    whole = gold.gold(*bars, SMALL, built_at=built())
    cols = ["product_id", "as_of_ts", "bar_count_5m", "trade_count_5m", "label_bar_count"]
    both = target.read(spark)
    rounded = [F.round(c, 9).alias(c) for c in ("rv_5m", "rv_60m", "label_rv_5m", "volume_5m")]
    a, b = both.select(*cols, *rounded), whole.select(*cols, *rounded)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def days(spark, bars, shift_days):
    """The same bars some days later."""
    return [b.withColumn("bar_ts", F.col("bar_ts") + F.make_dt_interval(F.lit(shift_days))) for b in bars]


def stored(spark, bars):
    book = refresh.book_bar_table(scratch_path(spark, "t-book"))
    trade = refresh.trade_bar_table(scratch_path(spark, "t-trade"))
    book.publish(bars[0])
    trade.publish(bars[1])
    return book, trade, refresh.gold_table(scratch_path(spark, "t-gold"))


def same_gold(got, want):
    cols = ["product_id", "as_of_ts", "bar_count_5m", "trade_count_5m", "label_bar_count"]
    rounded = [F.round(c, 9).alias(c) for c in ("rv_5m", "rv_60m", "label_rv_5m", "volume_5m")]
    a, b = got.select(*cols, *rounded), want.select(*cols, *rounded)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_refresh_opens_recent_days_only(spark, bars):
    """Days later, bars, base price and gold are read from the newest days alone."""
    book, trade, target = stored(spark, bars)
    assert refresh.refresh(spark, book, trade, target, SMALL, built()).rows_added > 0
    late = days(spark, bars, 40)
    book.append(late[0])
    trade.append(late[1])
    progress = refresh.progress_table(target).read(spark)
    work = refresh.pending(book.read(spark), trade.read(spark), progress, target.read(spark), SMALL)
    assert "PartitionFilters: [isnotnull(bar_date" in plan_of(work.book)
    # All products wait since the first days, so their bars are needed; each product's own.
    report = refresh.refresh(spark, book, trade, target, SMALL, built())
    later = days(spark, bars, 80)
    book.append(later[0])
    progress = refresh.progress_table(target).read(spark)
    work = refresh.pending(book.read(spark), trade.read(spark), progress, target.read(spark), SMALL)
    read = work.book.agg(F.min("bar_ts")).first()[0]
    assert report.rows_added > 0 and read > at(86_400 * 30)
    assert "PartitionFilters: [isnotnull(bar_date" in plan_of(work.rows(SMALL))
    reach = refresh.Reach.of(work.todo, refresh.LOOKBACK)
    assert reach.lagging is None
    recent = refresh.seen_by(target.read(spark), work.todo, "as_of_ts", "as_of_date", reach)
    assert "PartitionFilters: [isnotnull(as_of_date" in plan_of(recent)


def test_a_lagging_product_has_a_scan_of_its_own(spark, bars):
    """One product stands still for 40 days, then goes on; the others are read from
    recent days meanwhile, and the sum is one build."""
    late = days(spark, bars, 40)
    both = [b.unionByName(x) for b, x in zip(bars, late)]
    early = [b.unionByName(x.where("product_id <> 'A'")) for b, x in zip(bars, late)]
    book, trade, target = stored(spark, early)
    refresh.refresh(spark, book, trade, target, SMALL, built())
    rest = [x.where("product_id = 'A'") for x in late]
    book.append(rest[0])
    trade.append(rest[1])
    progress = refresh.progress_table(target).read(spark)
    work = refresh.pending(book.read(spark), trade.read(spark), progress, target.read(spark), SMALL)
    assert {r.product_id for r in work.todo.collect()} == {"A"}
    refresh.refresh(spark, book, trade, target, SMALL, built())
    whole = gold.gold(*both, SMALL, built_at=built())
    assert same_gold(target.read(spark), whole)


def test_new_products_and_lost_progress(spark, bars):
    """A product that comes later is built whole; rows that a broken-off build added
    before it could commit its progress are found and not added again."""
    first = [b.where("product_id = 'A'") for b in bars]
    book, trade, target = stored(spark, first)
    refresh.refresh(spark, book, trade, target, SMALL, built())
    for table, b in ((book, bars[0]), (trade, bars[1])):
        table.append(b.where("product_id <> 'A'"))
    progress = refresh.progress_table(target).read(spark)
    work = refresh.pending(book.read(spark), trade.read(spark), progress, target.read(spark), SMALL)
    whole = gold.gold(*bars, SMALL, built_at=built())
    half = work.rows(SMALL, built()).where(F.col("as_of_ts") < at(150 * 60))
    target.append(half)
    report = refresh.refresh(spark, book, trade, target, SMALL, built())
    assert same_gold(target.read(spark), whole)
    assert report.rows_total == whole.count()
    refresh.start_over(spark, book, trade, target)
    assert refresh.progress_table(target).read(spark).isEmpty()


def test_rows_that_are_there_are_refused(spark, bars):
    book, trade, target = stored(spark, bars)
    refresh.refresh(spark, book, trade, target, SMALL, built())
    rows = target.read(spark).drop("as_of_date")
    progress = refresh.scanned_progress(book.read(spark), rows.where(F.col("as_of_ts") < at(150 * 60)), SMALL)
    work = refresh.pending(book.read(spark), trade.read(spark), progress, None, SMALL)
    with pytest.raises(quality.QualityError, match="built already"):
        refresh.checked(work.rows(SMALL, built()), target.read(spark), work, SMALL)
