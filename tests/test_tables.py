"""Partitioned writes, versions, compaction and topic records."""

import json

import pytest
from pyspark.sql import functions as F

from tickflow import schemas
from tickflow.plans import landing, refresh
from tickflow.session import scratch_path, shared_dir
from tickflow.sinks import tables, topics
from tickflow.sources import relations
from tickflow.sources.topics import KafkaTopic
from tickflow.spec import FeedSpec


@pytest.fixture(scope="module")
def bars(spark):
    return spark.range(4000).select(
        F.concat(F.lit("P"), (F.col("id") % 2).cast("string")).alias("product_id"),
        F.timestamp_seconds(F.lit(1_785_110_400) + F.col("id") * 60)
        .cast("timestamp_ntz")
        .alias("bar_ts"),
        F.col("id").alias("trade_count"),
        *[F.rand(i).alias(f.name) for i, f in enumerate(schemas.TRADE_BAR.fields[3:])],
    )


def test_compaction_merges_files_and_keeps_rows(spark, bars):
    table = refresh.trade_bar_table(scratch_path(spark, "t-compact"))
    table.publish(bars.limit(0))
    for i in range(5):
        table.append(bars.where(F.col("trade_count") % 5 == i))
    before = table.read(spark)
    files = len(before.inputFiles())
    table.compact(spark)
    after = table.read(spark)
    assert len(after.inputFiles()) == 3 < files  # one file per day
    assert before.exceptAll(after).isEmpty() and after.count() == 4000


def test_compaction_rewrites_fragmented_days_alone(spark, bars):
    """Untouched days keep their files; readers see one version throughout."""
    table = refresh.trade_bar_table(scratch_path(spark, "t-days"))
    table.publish(bars)
    day = F.col("bar_ts").cast("date") == F.lit("2026-07-28").cast("date")
    for i in range(3):
        table.append(bars.where(day & (F.col("trade_count") % 3 == i)))
    held = table.read(spark)
    want = held.count()
    whole = {f for f in held.inputFiles() if "2026-07-28" not in f}
    assert list(table.fragmented(spark)) == ["bar_date=2026-07-28"]
    assert table.compact(spark) == 2
    now = table.read(spark)
    assert whole == {f for f in now.inputFiles() if "2026-07-28" not in f}
    assert len(now.inputFiles()) == 3 and now.count() == want == held.count()
    assert held.exceptAll(now).isEmpty() and set(now.columns) == set(held.columns)
    assert table.compact(spark) == 2  # nothing left to do
    # Rows that are added later join a day that was taken over.
    first = F.col("bar_ts").cast("date") == F.lit("2026-07-27").cast("date")
    table.append(bars.where(first))
    grown = table.read(spark)
    assert grown.count() == want + bars.where(first).count()
    assert table.compact(spark) == 3 and table.retain(spark, keep=1) == [1, 2]
    last = table.read(spark)
    assert grown.count and last.count() == want + bars.where(first).count()
    assert len(last.inputFiles()) == 3 and table.versions(spark) == [3]
    plan = last.where(F.col("bar_date") == F.lit("2026-07-28").cast("date"))
    assert len(plan.inputFiles()) == 3 and plan.count() == 2 * bars.where(day).count()
    table.publish(bars.limit(7))
    table.retain(spark, keep=1)
    assert table.read(spark).count() == 7 and table.versions(spark) == [4]


def test_versions_are_retained_and_reset(spark, bars):
    table = refresh.trade_bar_table(scratch_path(spark, "t-versions"))
    assert table.read(spark).isEmpty()
    for _ in range(4):
        table.publish(bars)
    assert table.versions(spark) == [1, 2, 3, 4]
    assert table.retain(spark, keep=2) == [1, 2]
    assert table.versions(spark) == [3, 4]
    table.reset(spark)
    assert table.read(spark).isEmpty() and table.versions(spark) == [3, 4, 5]


def test_schemas_are_not_shared(spark):
    before = len(schemas.TRADE_BAR.fields)
    refresh.trade_bar_table("x"), refresh.trade_bar_table("y")
    assert len(schemas.TRADE_BAR.fields) == before


def test_reads_prune_by_day(spark, bars):
    from datetime import datetime

    path = scratch_path(spark, "t-prune")
    tables.write_partitioned(bars, path, "bar_ts", "bar_date")
    stored = relations.read_table(spark, path, schemas.TRADE_BAR, "bar_date")
    recent = relations.since(stored, "bar_ts", "bar_date", datetime(2026, 7, 28, 12))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bar_date" in plan
    assert "GreaterThan(bar_ts" in plan
    assert recent.count() == 4000 - (36 * 60 + 1)


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_scratch_tables_go_with_their_work(spark):
    import os

    from tickflow.session import Scratch, materialize

    gone = lambda df: not os.path.exists(df.inputFiles()[0].removeprefix("file://"))
    with Scratch(spark) as outer:
        first = materialize(spark.range(5), "t-first")
        with Scratch(spark) as inner:
            second = materialize(first, "t-second")
            kept = inner.keep(second.selectExpr("id * 2 AS id"), "t-kept")
            assert not gone(second)
        assert gone(second) and not gone(first) and kept.count() == 5
        last = outer.keep(kept, "t-last")
    assert gone(first) and gone(kept) and last.count() == 5
    free = materialize(spark.range(1), "t-free")
    with pytest.raises(ValueError), Scratch(spark):
        lost = materialize(free, "t-lost")
        raise ValueError
    assert gone(lost) and not gone(free) and not Scratch._open


def test_records_are_keyed_and_limited(spark, bars):
    spec = FeedSpec(max_message_bytes=120, truncated_bytes=32)
    wide = bars.limit(4).withColumn("pad", F.when(F.col("trade_count") == 1, F.repeat(F.lit("x"), 500)))
    sent = topics.limited(topics.keyed(wide.select("product_id", "trade_count", "pad"), "t"), spec)
    rows = {r.key + r.topic: json.loads(r.value) for r in sent.collect()}
    assert rows["P1dlq"]["error"].endswith("bytes) for t") and len(rows["P1dlq"]["raw"]) == 35
    assert rows["P0t"]["product_id"] == "P0"
    # What is already a dead letter is never wrapped again.
    again = topics.limited(sent.withColumn("topic", F.lit("dlq")), FeedSpec(max_message_bytes=1))
    assert again.exceptAll(sent.withColumn("topic", F.lit("dlq"))).isEmpty()


def test_landing_parses_once_and_loses_nothing(spark):
    from tests.test_routing import heartbeat, match, raw

    feed = raw(spark, match(1), match(2, pad="x" * 500), heartbeat(2), "{oops", match(4))
    done = landing.land(feed, FeedSpec(max_message_bytes=400, truncated_bytes=16))
    assert [r.trade_id for r in done.trades.orderBy("arrival_seq").collect()] == [1, 4]
    assert done.heartbeats.count() == 1 and done.books.count() == 0
    assert sorted(r.arrival_seq for r in done.dead.collect()) == [1, 3]
    assert not landing.gate(done)
    epochs = landing.epochs(raw(spark, {"type": "subscriptions"}, match(1)))
    assert [r.conn_epoch for r in epochs.orderBy("arrival_seq").collect()] == [1, 1]


def test_kafka_options():
    """No broker here: only the options are checked."""
    topic = KafkaTopic("host:1", "trades", per_trigger=5, options={"kafka.security.protocol": "X"})
    options = topic._options()
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "trades"
    assert options["kafka.security.protocol"] == "X"


def test_jdbc_reader_options(spark, monkeypatch):
    """A stub in place of a database."""
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def option(self, key, value):
            seen[key] = value
            return self

        def options(self, **more):
            seen.update(more)
            return self

        def load(self):
            return "rows"

    class Session:
        read = Reader()

    got = relations.read_relation(
        Session(), "jdbc:x", "predictions", "id", ("0", "9"), 4, user="u"
    )
    assert got == "rows" and seen["format"] == "jdbc" and seen["dbtable"] == "predictions"
    assert (seen["partitionColumn"], seen["numPartitions"], seen["user"]) == ("id", "4", "u")
