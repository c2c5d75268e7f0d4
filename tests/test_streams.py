"""Streams equal batch; restarts, late rows, extra fields, repeated batches."""

import json
import math
import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickflow import schemas
from tickflow.operators import bars, book, gold, router
from tickflow.plans import refresh
from tickflow.session import materialize, scratch_path
from tickflow.sources.topics import FileTopic, json_bars
from tickflow.spec import BarSpec, FeedSpec
from tickflow.streaming import bars as stream_bars
from tickflow.streaming import book_state, online

T0 = datetime(2024, 3, 5, 9, 0, 0)


def iso(seconds):
    return (T0 + timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%S.%f") + "Z"


def trade(tid, at, product="A", **more):
    return {"type": "match", "product_id": product, "trade_id": tid, "price": "10", "size": "1",
            "side": "buy", "time": iso(at), **more}


class Feed:
    """A folder of message files with rising modification times."""

    def __init__(self, spark, name):
        self.spark, self.path = spark, scratch_path(spark, name)
        self.seq, self.clock = 0, time.time() - 10_000

    def add(self, *messages, epochs=None):
        rows = [
            (json.dumps(m), self.seq + i, (epochs or {}).get(i, 1), iso(0))
            for i, m in enumerate(messages)
        ]
        self.seq += len(rows)
        df = self.spark.createDataFrame(rows, schemas.RAW_MESSAGE).coalesce(1)
        df.write.mode("append").parquet(self.path)
        folder = self.path.removeprefix("file:")
        self.clock += 100
        for f in os.listdir(folder):
            full = os.path.join(folder, f)
            if f.endswith(".parquet") and os.path.getmtime(full) > time.time() - 5_000:
                os.utime(full, (self.clock, self.clock))

    def stream(self):
        return FileTopic(self.path, files_per_trigger=1).stream(self.spark)

    def batch(self):
        return FileTopic(self.path).read(self.spark)


def run(stream, out, log):
    query = stream_bars.to_table(stream, out, log, every=None)
    query.awaitTermination()
    return query


def counts(spark, out):
    stored = spark.read.schema(schemas.TRADE_BAR).parquet(out)
    return {r.bar_ts: r.trade_count for r in stored.collect()}


def test_late_trades_inside_and_outside_the_watermark(spark):
    feed = Feed(spark, "t-late")
    out, log = scratch_path(spark, "t-late-out"), scratch_path(spark, "t-late-log")
    feed.add(trade(1, 0), trade(2, 40))
    feed.add(trade(3, 25, venue={"new": "field"}))  # 15 s late: counted
    feed.add(trade(4, 120))
    feed.add(trade(8, 121))  # lateness is judged by the clock one batch back
    feed.add(trade(5, 60))  # 60 s late: dropped
    feed.add({**trade(6, 0), "time": "2024-03-05T09:02:00Z"})  # unreadable clock
    feed.add(trade(7, 300))
    run(stream_bars.trade_bars(feed.stream()), out, log)
    at = lambda s: T0 + timedelta(seconds=s)
    assert counts(spark, out) == {at(0): 1, at(25): 1, at(40): 1, at(120): 1, at(121): 1}


def test_dropped_rows_are_counted(spark):
    feed = Feed(spark, "t-drop")
    feed.add(trade(1, 0), trade(2, 40))
    feed.add(trade(4, 120))
    feed.add(trade(8, 121))
    feed.add(trade(5, 60), trade(6, 61), trade(7, 300))
    late = stream_bars.LateRows()
    spark.streams.addListener(late)
    try:
        table = refresh.live_trade_bars(scratch_path(spark, "t-drop-table"))
        bars_ = stream_bars.trade_bars(feed.stream())
        query = stream_bars.fan_out(bars_, scratch_path(spark, "t-drop-log"), table, every=None, name="late")
        query.awaitTermination()
        for _ in range(50):
            if late.dropped.get("late"):
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(late)
    assert late.dropped == {"late": 2} and table.read(spark).count() == 4


def book_items():
    bids, asks = [["100", "3"], ["99", "2"]], [["102", "6"], ["103", "4"]]
    yield {"type": "snapshot", "product_id": "A", "bids": bids, "asks": asks}
    for i in range(1, 60):
        side, price = ("buy", 101 - i % 4) if i % 2 else ("sell", 102 + i % 3)
        yield {"type": "l2update", "product_id": "A", "time": iso(i * 5),
               "changes": [[side, str(price), str(i % 6)]]}


def test_book_state_survives_restarts_and_equals_batch(spark):
    """Stopped and started between files, mid-book, without a new snapshot."""
    feed = Feed(spark, "t-book")
    out, log = scratch_path(spark, "t-book-out"), scratch_path(spark, "t-book-log")
    items = list(book_items())
    for lo in range(0, 60, 20):
        feed.add(*items[lo : lo + 20], epochs={7: 0})  # one stale delta per file
        run(stream_bars.book_bars(feed.stream()), out, log)
    messages = router.book_messages(router.route(feed.batch()))
    want = bars.book_bars(book.book_tops(messages, FeedSpec(chunk_rows=16)))
    got = spark.read.schema(schemas.BOOK_BAR).parquet(out)
    final = got.agg(F.max("bar_ts")).first()[0]
    want = want.where(F.col("bar_ts") <= F.lit(final).cast("timestamp_ntz"))
    got = got.select(*want.columns)
    assert got.count() > 30
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_stream_takes_over_a_batch_in_mid_segment(spark):
    """A batch over the first messages, then a stream over the rest: as one batch."""
    items = list(book_items())
    items[45] = {"type": "snapshot", "product_id": "A", "bids": [["90", "1"]], "asks": [["95", "2"]]}
    for cut in (17, 46):
        feed = Feed(spark, f"t-take{cut}")
        feed.add(*items[:cut], epochs={7: 0})
        spec = FeedSpec(chunk_rows=16)
        first = router.book_messages(router.route(feed.batch()))
        done = materialize(book.book_tops(first, spec), "t-tops")
        opening = materialize(book.closing_books(first, done, spec), "t-opening")
        late = Feed(spark, f"t-go{cut}")
        late.seq = cut
        late.add(*items[cut:])
        out, log = scratch_path(spark, "t-go-out"), scratch_path(spark, "t-go-log")
        run(stream_bars.book_tops(late.stream(), opening=opening), out, log)
        columns = ["arrival_seq", "segment", "best_bid", "best_bid_qty", "best_ask", "best_ask_qty",
                   "bid_depth5", "ask_depth5", "ofi_delta", "conn_epoch"]
        got = done.select(columns).union(spark.read.parquet(out).select(columns))
        every = feed.batch().union(late.batch())
        want = book.book_tops(router.book_messages(router.route(every)), spec).select(columns)
        assert got.count() > 40
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


class Kept(dict):
    """Map and value state in memory."""

    def updateValue(self, key, value):
        self[key] = value

    def update(self, value):
        self["all"] = value


def test_books_to_take_over_travel_without_lists(spark):
    """What rides along with a batch's messages is flat, and nothing of a book is lost in it."""
    before = [0.1, 1e-300, 1e22, 2.0]
    books = spark.createDataFrame(
        [
            ("A", 3, 2**62 + 1, 7, before, [True, False], [0.1, float("inf")], [1e-7, 0.3]),
            ("B", 0, None, 9, [None] * 4, None, None, None),
        ],
        "product_id string, segment long, epoch long, last_seq long, before array<double>,"
        " is_bid array<boolean>, price array<double>, size array<double>",
    )
    packed = book_state.packed(books)
    assert packed.dtypes == [("product_id", "string"), ("book", "string")]
    rows = packed.orderBy("product_id").toPandas()
    found = []
    for i in range(2):
        state = book_state.BookState(5)
        state.bids, state.asks, state.meta = Kept(), Kept(), Kept()
        state.handleInitialState((rows["product_id"][i],), rows[i : i + 1], None)
        found.append((dict(state.bids), dict(state.asks), state.meta["all"]))
    assert found == [
        ({(-0.1,): (1e-7,)}, {(math.inf,): (0.3,)}, (2**62 + 1, *before, 3, 7, 0, 0)),
        ({}, {}, (None, None, None, None, None, 0, 9, 0, 0)),
    ]


def test_tops_report_drops_and_disorder(spark):
    feed = Feed(spark, "t-tops")
    out, log = scratch_path(spark, "t-tops-out"), scratch_path(spark, "t-tops-log")
    items = list(book_items())
    feed.add(*items[:20], epochs={3: 2, 4: 2})
    run(stream_bars.book_tops(feed.stream()), out, log)
    last = spark.read.parquet(out).orderBy(F.desc("arrival_seq")).first()
    assert (last.dropped, last.disorder, last.segment) == (2, 0, 1)


def json_topic(spark, path, schema):
    sent = spark.read.schema("key string, value string").json(f"{path}/batch_id=*/topic=*")
    return json_bars(sent.select("value", F.lit(1).alias("arrival_seq")), schema)


def test_a_batch_is_worked_out_once_and_replaces_itself(spark):
    """Other sinks read what was committed; a second try leaves one copy in the table."""
    feed = Feed(spark, "t-fan")
    feed.add(*[trade(i, i) for i in range(20)])
    feed.add(*[trade(i, i + 200) for i in range(20)])
    feed.add(trade(99, 90_000), trade(100, 90_050), trade(101, 90_100))
    log, topic = scratch_path(spark, "t-fan-log"), scratch_path(spark, "t-fan-topic")
    table = refresh.live_trade_bars(scratch_path(spark, "t-fan-table"))
    worked = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(n):
        worked.add(1)
        return n

    counted = stream_bars.trade_bars(feed.stream()).withColumn("trade_count", seen("trade_count"))
    got = []
    query = stream_bars.fan_out(
        counted,
        log,
        table,
        [stream_bars.to_topic("bars.trade", topic), lambda b, i: got.append((i, b.collect()))],
        every=None,
    )
    query.awaitTermination()
    stored = table.read(spark)
    assert stored.count() == worked.value == 42  # the last window is still open
    assert {r.bar_date.day for r in stored.collect()} == {5, 6}
    assert sum(len(rows) for _, rows in got) == 42
    assert json_topic(spark, topic, schemas.TRADE_BAR).count() == 42
    before = sorted(map(tuple, stored.collect()))
    again = max(got, key=lambda x: len(x[1]))
    table.commit(spark.createDataFrame(again[1], schemas.TRADE_BAR), again[0])
    assert sorted(map(tuple, table.read(spark).collect())) == before and len(before) == 42
    plan = table.batch(spark, again[0])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan
    table.reset(spark)
    assert table.read(spark).isEmpty()


def test_feed_to_gold_equals_batch(spark):
    """Both streams to day tables to gold, with a restart and a batch that is tried again."""
    spec = BarSpec(step_seconds=2, chunk_steps=80)
    feed = Feed(spark, "t-job")
    items = list(book_items())
    trades = [trade(i, 3 * i, price=str(100 + i % 5)) for i in range(110)]
    job = stream_bars.BarsJob(
        refresh.live_trade_bars(scratch_path(spark, "t-job-trade")),
        refresh.live_book_bars(scratch_path(spark, "t-job-book")),
        scratch_path(spark, "t-job-log"),
    )
    target = refresh.gold_table(scratch_path(spark, "t-job-gold"))
    now = F.lit("2024-03-06 00:00:00").cast("timestamp_ntz")
    for lo in range(0, 60, 20):
        feed.add(*items[lo : lo + 20], *trades[2 * lo : 2 * lo + 40])
        for query in job.start(feed.stream(), spec, every=None):
            query.awaitTermination()
        refresh.refresh(spark, job.book, job.trade, target, spec, now)
    last = job.book._stored(spark).agg(F.max("batch_id")).first()[0]
    job.book.commit(spark.createDataFrame(job.book.batch(spark, last).collect(), schemas.BOOK_BAR), last)
    assert refresh.refresh(spark, job.book, job.trade, target, spec, now).rows_added == 0
    routed = router.route(feed.batch())
    messages = router.book_messages(routed)
    closed = {t: t.read(spark).agg(F.max("bar_ts")).first()[0] for t in (job.book, job.trade)}
    upto = lambda df, t: df.where(F.col("bar_ts") <= F.lit(closed[t]).cast("timestamp_ntz"))
    books = upto(bars.book_bars(book.book_tops(messages), spec), job.book)
    matched = upto(bars.trade_bars(router.matches(router.trades(routed)), spec), job.trade)
    want = gold.gold(books, matched, spec, built_at=now)
    columns = ["product_id", "as_of_ts", "bar_count_5m", "label_bar_count", "trade_count_5m"]
    assert target.read(spark).select(columns).exceptAll(want.select(columns)).isEmpty()
    assert target.read(spark).count() == want.count() > 0


@pytest.mark.parametrize("restart", [False, True])
def test_online_features_need_both_streams_and_come_in_order(spark, restart):
    """Minute points fire when both streams are two seconds past them."""
    import math

    spec = BarSpec()
    paths = {n: scratch_path(spark, f"t-on-{n}") for n in ("book", "trade", "out", "log")}
    zoned = {}
    for name, schema in (("book", schemas.BOOK_BAR), ("trade", schemas.TRADE_BAR)):
        fields = [(f.name, "timestamp" if f.name == "bar_ts" else f.dataType.simpleString())
                  for f in schema.fields]
        zoned[name] = ", ".join(f"{n} {t}" for n, t in fields)

    def write(name, rows):
        df = spark.createDataFrame(rows, zoned[name]).coalesce(1)
        df.write.mode("append").parquet(paths[name])

    def book_rows(lo, hi):
        return [("A", T0 + timedelta(seconds=s), 100.0 + s / 100, 1.0, 1.0, 1.0, 1.0, 2.0, 1.0,
                 1.0, 1, 1) for s in range(lo, hi, 10)]

    def trade_rows(lo, hi):
        return [("A", T0 + timedelta(seconds=s), 1, 1.0, 1.0, 0.0, 1.0, 1.0, 1.0)
                for s in range(lo, hi, 10)]

    def drain():
        streams = [spark.readStream.schema(zoned[n]).parquet(paths[n]) for n in ("book", "trade")]
        run(online.online_features(*streams, spec), paths["out"], paths["log"])

    write("book", book_rows(0, 600))
    write("trade", trade_rows(0, 300))
    if restart:
        drain()
        early = spark.read.parquet(paths["out"])
        # The trade stream ends at 290 s, so minute 4 is the last one due.
        assert early.agg(F.max("as_of_ts")).first()[0] == T0 + timedelta(minutes=4)
    # After a restart Spark waits until each stream has delivered again.
    write("book", book_rows(600, 720))
    write("trade", trade_rows(300, 720))
    drain()
    rows = spark.read.parquet(paths["out"]).orderBy("as_of_ts").collect()
    assert [r.as_of_ts for r in rows] == [T0 + timedelta(minutes=m) for m in range(1, 12)]
    r = rows[6]  # as of minute 7: bars of (2 min, 7 min]
    assert (r.bar_count_5m, r.trade_count_5m, r.taker_imb_5m) == (30, 30.0, 1.0)
    mids = [100.0 + s / 100 for s in range(0, 421, 10)]
    want = math.sqrt(sum(math.log(b / a) ** 2 for a, b in zip(mids, mids[1:])))
    assert math.isclose(r.rv_60m, want, rel_tol=1e-12)
    assert math.isclose(r.depth_imb_5m, 1 / 3)


def test_a_product_behind_the_others_loses_no_bars(spark):
    """Product B's bars come five minutes after A's; windows reach back over 90 minutes."""
    spec = BarSpec(horizons=(1, 5, 15, 90))
    feed = FeedSpec(watermark="6 minutes")
    paths = {n: scratch_path(spark, f"t-lag-{n}") for n in ("book", "trade", "out", "log")}
    book_type = ", ".join(
        f"{f.name} {'timestamp' if f.name == 'bar_ts' else f.dataType.simpleString()}"
        for f in schemas.BOOK_BAR.fields
    )
    trade_type = ", ".join(
        f"{f.name} {'timestamp' if f.name == 'bar_ts' else f.dataType.simpleString()}"
        for f in schemas.TRADE_BAR.fields
    )

    def mid(s):
        return 50.0 + (s * s // 30) % 7

    def deliver(product, lo, hi):
        at = [T0 + timedelta(seconds=s) for s in range(lo, hi, 30)]
        mids = [mid(s) for s in range(lo, hi, 30)]
        book = [(product, t, m, m, m, 1.0, 1.0, 2.0, 1.0, 1.0, 1, 1) for t, m in zip(at, mids)]
        trade = [(product, t, 1, 1.0, 1.0, 0.0, 1.0, 1.0, 1.0) for t in at]
        for name, rows, kind in (("book", book, book_type), ("trade", trade, trade_type)):
            frame = spark.createDataFrame(rows, kind).coalesce(1)
            frame.write.mode("append").parquet(paths[name])

    ends = [0, 3000, 6000, 9000]
    for lo, hi in zip(ends, ends[1:]):
        deliver("A", lo, hi)
        deliver("B", max(lo - 300, 0), hi - 300)
        streams = [
            spark.readStream.schema(k).parquet(paths[n])
            for n, k in (("book", book_type), ("trade", trade_type))
        ]
        run(online.online_features(*streams, spec, feed), paths["out"], paths["log"])
    found = {}
    for r in spark.read.parquet(paths["out"]).collect():
        found.setdefault(r.product_id, {})[r.as_of_ts] = r
    assert set(found["A"]) == set(found["B"]) and len(found["A"]) > 130
    longest = schemas.FEATURES[3]
    for minute in (30, 89, 120, 135):
        at = T0 + timedelta(minutes=minute)
        lo = max(minute * 60 - 90 * 60, -1)
        mids = [mid(s) for s in range(0, minute * 60 + 1, 30)]
        moves = [
            math.log(b / a) ** 2
            for s, a, b in zip(range(30, minute * 60 + 1, 30), mids, mids[1:])
            if s > lo
        ]
        for product in ("A", "B"):
            assert math.isclose(found[product][at][longest], math.sqrt(sum(moves)))


def test_a_silent_side_is_not_waited_for(spark):
    """Points come out after the time-out; a side that wakes up makes no duplicate."""
    spec, feed = BarSpec(), FeedSpec(idle_seconds=3)
    paths = {n: scratch_path(spark, f"t-idle-{n}") for n in ("book", "trade", "out", "log")}
    zoned = {}
    for name, schema in (("book", schemas.BOOK_BAR), ("trade", schemas.TRADE_BAR)):
        fields = [(f.name, "timestamp" if f.name == "bar_ts" else f.dataType.simpleString())
                  for f in schema.fields]
        zoned[name] = ", ".join(f"{n} {t}" for n, t in fields)
        spark.createDataFrame([], zoned[name]).write.parquet(paths[name])

    def write(name, rows):
        spark.createDataFrame(rows, zoned[name]).coalesce(1).write.mode("append").parquet(paths[name])

    def book_rows(lo, hi):
        return [("A", T0 + timedelta(seconds=s), 100.0 + s / 100, 1.0, 1.0, 1.0, 1.0, 2.0, 1.0,
                 1.0, 1, 1) for s in range(lo, hi, 10)]

    def trade_rows(lo, hi):
        return [("A", T0 + timedelta(seconds=s), 1, 1.0, 1.0, 0.0, 1.0, 1.0, 1.0)
                for s in range(lo, hi, 10)]

    write("book", book_rows(0, 300))
    write("trade", trade_rows(0, 130))
    streams = [spark.readStream.schema(zoned[n]).parquet(paths[n]) for n in ("book", "trade")]
    live = online.idle_online_features(*streams, spec, feed)
    query = stream_bars.to_table(live, paths["out"], paths["log"], every="1 second")

    def points():
        try:
            rows = spark.read.schema(live.schema).parquet(paths["out"]).collect()
        except Exception:  # noqa: BLE001 - nothing is written yet
            return {}
        found = {r.as_of_ts: r.trade_count_5m for r in rows}
        assert len(found) == len(rows)
        return found

    def wait(n):
        for _ in range(120):
            if len(points()) >= n:
                break
            time.sleep(0.5)
        return points()

    try:
        # Trades end at 120 s: minute 2 needs them two seconds past it, so one point is due.
        first = wait(4)
        assert sorted(first) == [T0 + timedelta(minutes=m) for m in (1, 2, 3, 4)]
        assert first[T0 + timedelta(minutes=4)] == 13
        write("trade", trade_rows(130, 400))  # wakes up: counts for later points alone
        write("book", book_rows(300, 400))
        last = wait(6)
    finally:
        query.stop()
    assert sorted(last) == [T0 + timedelta(minutes=m) for m in range(1, 7)]
    assert last[T0 + timedelta(minutes=4)] == 13 and last[T0 + timedelta(minutes=6)] == 30
