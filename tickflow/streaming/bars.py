"""Streaming bars: event-time windows under a watermark, several sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickflow.functions.clock import EPOCH
from tickflow.operators import bars, book, router
from tickflow.sinks import topics
from tickflow.sinks.tables import BatchTable
from tickflow.spec import BarSpec, FeedSpec
from tickflow.streaming.book_state import BookState, packed

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

BatchWriter = Callable[[DataFrame, int], None]


def _clocked(df: DataFrame, feed: FeedSpec) -> DataFrame:
    """A watermark needs the zoned type; the session zone is UTC."""
    return df.withColumn("event_ts", F.col("event_ts").cast("timestamp")).withWatermark(
        "event_ts", feed.watermark
    )


def trade_bars(raw: DataFrame, spec: BarSpec = BarSpec(), feed: FeedSpec = FeedSpec()) -> DataFrame:
    """Trade bars of closed windows. Trades without a readable clock never count."""
    matches = router.matches(router.trades(router.route(raw)))
    return bars.trade_bars(_clocked(matches.where(F.col("event_ts") > F.lit(EPOCH)), feed), spec)


def book_tops(
    raw: DataFrame, feed: FeedSpec = FeedSpec(), opening: DataFrame | None = None
) -> DataFrame:
    """Tops of book from keyed state; needs the RocksDB state store.

    ``opening`` has the books that a batch left (``operators.book.closing_books``): the
    stream then goes on in mid-segment with the messages that follow.
    """
    messages = router.book_messages(router.route(raw))
    timed = messages.withColumn(
        "event_ts", F.timestamp_millis(book.iso_millis("time"))
    ).withWatermark("event_ts", feed.watermark)
    tops = timed.drop("time").groupBy("product_id").transformWithStateInPandas(
        BookState(feed.depth_levels),
        outputStructType=BookState.output,
        outputMode="Append",
        timeMode="EventTime",
        initialState=None if opening is None else packed(opening).groupBy("product_id"),
        eventTimeColumnName="event_ts",
    )
    bid, ask = F.col("best_bid"), F.col("best_ask")
    return tops.withColumns({"mid": book.mid(bid, ask), "spread": ask - bid})


def book_bars(raw: DataFrame, spec: BarSpec = BarSpec(), feed: FeedSpec = FeedSpec()) -> DataFrame:
    """Book bars of closed windows, straight from messages."""
    return bars.book_bars(book_tops(raw, feed), spec)


def fan_out(
    stream: DataFrame,
    checkpoint: str,
    table: BatchTable,
    writers: Sequence[BatchWriter] = (),
    every: str | None = "30 seconds",
    name: str | None = None,
) -> StreamingQuery:
    """Commit each batch to a table once, and hand on what was committed.

    The batch itself is worked out only for the table; the other sinks read it back from
    there, so they hold the same rows. A batch that is tried again replaces itself in the
    table and in sinks that key their output by its number; topics may get it twice.
    ``every=None`` drains what is there.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table.commit(batch, batch_id)
        for writer in writers:
            writer(table.batch(batch.sparkSession, batch_id), batch_id)

    out = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    out = out.foreachBatch(write)
    if name:
        out = out.queryName(name)
    out = out.trigger(processingTime=every) if every else out.trigger(availableNow=True)
    return out.start()


def to_topic(topic: str, path: str, feed: FeedSpec = FeedSpec()) -> BatchWriter:
    """A writer of keyed JSON records to a topic of files."""

    def write(batch: DataFrame, batch_id: int) -> None:
        topics.write_files(topics.limited(topics.keyed(batch, topic), feed), path, batch_id)

    return write


@dataclass(frozen=True)
class BarsJob:
    """Both bar streams of a feed: day tables, topics of the same rows, checkpoints."""

    trade: BatchTable
    book: BatchTable
    checkpoint: str
    trade_sinks: Sequence[BatchWriter] = ()
    book_sinks: Sequence[BatchWriter] = ()

    def start(
        self,
        raw: DataFrame,
        spec: BarSpec = BarSpec(),
        feed: FeedSpec = FeedSpec(),
        every: str | None = "30 seconds",
    ) -> tuple[StreamingQuery, StreamingQuery]:
        """Start both over one raw feed; each reads its own messages from it."""
        use_state_store(raw.sparkSession)
        root = self.checkpoint.rstrip("/")
        return (
            fan_out(trade_bars(raw, spec, feed), f"{root}/trade", self.trade, self.trade_sinks, every),
            fan_out(book_bars(raw, spec, feed), f"{root}/book", self.book, self.book_sinks, every),
        )


class LateRows(StreamingQueryListener):
    """Counts the rows that each query's watermarks have dropped, by the query's name.

    Register it with ``spark.streams.addListener`` before the queries start. A query
    without a name goes by its id.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(event.name or str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        name = progress.name or str(progress.id)
        late = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        self.dropped[name] = self.dropped.get(name, 0) + late

    def onQueryTerminated(self, event) -> None:
        pass


def to_table(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds"
) -> StreamingQuery:
    """Exactly-once append to a folder of parquet files."""
    out = stream.writeStream.outputMode("append").format("parquet")
    out = out.option("path", path).option("checkpointLocation", checkpoint)
    out = out.trigger(processingTime=every) if every else out.trigger(availableNow=True)
    return out.start()


def use_state_store(spark) -> None:
    """State larger than memory and keyed map state need RocksDB."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


