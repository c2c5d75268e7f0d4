"""Level-2 order books from snapshots and deltas.

A snapshot replaces the whole book, so a product's history falls into segments;
a segment can still be arbitrarily long. Each product's history is therefore cut
into chunks, the book at each chunk start is derived with plain aggregation (last
change per price level), and every chunk is replayed on its own. Only the replay is
Python, and it never holds more than one chunk plus one book.

Chunks are balanced per product: the arrival order is first cut into small buckets, a
bucket weighs as many chunks as it has changes per ``chunk_rows`` or per level that is
live when it starts, whichever is more, and prefix sums of these weights number the
chunks. So a slow product's chunk spans many buckets, and no chunk opens with many more
levels than it has changes, however many products arrive interleaved.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from math import inf

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickflow import schemas
from tickflow.functions.clock import iso_millis, millis_time
from tickflow.functions.flow import mid, order_flow
from tickflow.operators.ordered import arrival_chunk, over_chunks, running_last, running_sum
from tickflow.session import materialize
from tickflow.spec import FeedSpec

TOP_COLUMNS = ("best_bid", "best_bid_qty", "best_ask", "best_ask_qty")


class Side:
    """Price levels of one side, best first (``sign`` -1 for bids).

    The head (best price, its size, depth of the best levels) is kept until a
    change reaches into it; most changes are further away.
    """

    __slots__ = ("sign", "ranks", "sizes", "head", "edge")

    def __init__(self, sign: int):
        self.sign = sign
        self.ranks: list[float] = []
        self.sizes: dict[float, float] = {}
        self.head: tuple[float, float, float] | None = None
        self.edge = 0.0

    def put(self, price: float, size: float) -> None:
        rank = self.sign * price
        if rank not in self.sizes:
            insort(self.ranks, rank)
        self.sizes[rank] = size
        if rank <= self.edge:
            self.head = None

    def drop(self, price: float) -> None:
        rank = self.sign * price
        if self.sizes.pop(rank, None) is not None:
            del self.ranks[bisect_left(self.ranks, rank)]
            if rank <= self.edge:
                self.head = None

    def clear(self) -> None:
        self.ranks.clear()
        self.sizes.clear()
        self.head = None

    def best(self, depth: int) -> tuple[float, float, float]:
        """Best price, its size, and the size of the best ``depth`` levels."""
        if self.head is None:
            near = self.ranks[:depth]
            sizes = self.sizes
            total = sum([sizes[r] for r in near])
            self.head = (self.sign * near[0], sizes[near[0]], total)
            self.edge = near[-1] if len(near) == depth else inf
        return self.head


class Replay:
    """One product's book while messages are applied in arrival order."""

    def __init__(self, depth: int):
        self.depth = depth
        self.bids = Side(-1)
        self.asks = Side(1)

    def apply(self, is_snapshot, is_bid, price, size) -> None:
        """Apply one message; a zero size in a delta removes the level."""
        if is_snapshot:
            self.bids.clear()
            self.asks.clear()
        for bid, p, q in zip(is_bid, price, size):
            if p != p or q != q:  # no number
                continue
            side = self.bids if bid else self.asks
            if q == 0 and not is_snapshot:
                side.drop(p)
            else:
                side.put(p, q)

    def top(self):
        """(bid, bid qty, ask, ask qty, bid depth, ask depth), or None when one
        side is empty or the book is locked or crossed."""
        if not self.bids.ranks or not self.asks.ranks:
            return None
        bid, bid_qty, bid_depth = self.bids.best(self.depth)
        ask, ask_qty, ask_depth = self.asks.best(self.depth)
        if bid >= ask:
            return None
        return bid, bid_qty, ask, ask_qty, bid_depth, ask_depth


def flow_delta(before, now) -> float:
    """Row form of ``functions.flow.order_flow`` for the replay."""
    bid0, bid_qty0, ask0, ask_qty0 = before
    bid1, bid_qty1, ask1, ask_qty1 = now
    gained = (bid_qty1 if bid1 >= bid0 else 0.0) - (bid_qty0 if bid1 <= bid0 else 0.0)
    offered = (ask_qty1 if ask1 <= ask0 else 0.0) - (ask_qty0 if ask1 >= ask0 else 0.0)
    return gained - offered


def segments(messages: DataFrame, spec: FeedSpec = FeedSpec()) -> DataFrame:
    """Add chunk, segment (snapshots so far), the book's epoch, and stale.

    A delta is stale when its connection epoch differs from that of the latest
    snapshot; two missing epochs are equal.
    """
    flagged = arrival_chunk(messages, spec.chunk_rows).withColumn(
        "_snap", F.col("is_snapshot").cast("int")
    )
    placed = over_chunks(
        flagged,
        "product_id",
        "arrival_seq",
        "chunk",
        [
            running_sum("_snap", "segment"),
            running_last("conn_epoch", F.col("is_snapshot"), "book_epoch", "arrival_seq"),
        ],
    )
    return placed.withColumns(
        {
            "segment": F.col("segment").cast("long"),
            "stale": ~F.col("is_snapshot") & ~F.col("conn_epoch").eqNullSafe(F.col("book_epoch")),
        }
    ).drop("_snap")


def _bucketed(messages: DataFrame, spec: FeedSpec) -> DataFrame:
    return arrival_chunk(messages, spec.bucket_rows).withColumnRenamed("chunk", "bucket")


def bucket_index(messages: DataFrame, spec: FeedSpec = FeedSpec()) -> DataFrame:
    """One row per (product, bucket of arrivals): its changes and the book around it.

    ``no`` numbers a product's buckets densely; ``seg_*`` and ``epoch_*`` describe the
    book before and after the bucket; ``reach`` is the last bucket in which the book left
    behind is still open.
    """
    snap = F.col("is_snapshot")
    at = F.when(snap, F.col("arrival_seq"))
    found = (
        _bucketed(messages, spec)
        .groupBy("product_id", "bucket")
        .agg(
            F.sum(F.greatest(F.size("price"), F.lit(1)).cast("long")).alias("changes"),
            F.count_if(snap).alias("snaps"),
            F.max(at).alias("last_snap"),
            F.max_by("conn_epoch", at).alias("own_epoch"),
        )
    )
    order = W.partitionBy("product_id").orderBy("bucket")
    past = order.rowsBetween(W.unboundedPreceding, -1)
    reset = F.when(F.col("snaps") > 0, F.struct("own_epoch"))
    numbered = found.withColumns(
        {
            "no": F.row_number().over(order).cast("long"),
            "seg_before": F.coalesce(F.sum("snaps").over(past), F.lit(0)),
            "epoch_before": F.last(reset, ignorenulls=True).over(past)["own_epoch"],
        }
    )
    open_in = W.partitionBy("product_id", "seg_before")
    return (
        numbered.withColumns(
            {
                "seg_after": F.col("seg_before") + F.col("snaps"),
                "epoch_after": F.when(F.col("snaps") > 0, F.col("own_epoch")).otherwise(
                    F.col("epoch_before")
                ),
                "_reach": F.max("no").over(open_in),
            }
        )
        .withColumn("reach", F.lead("_reach").over(order))
        .drop("snaps", "own_epoch", "_reach")
    )


def last_levels(messages: DataFrame, spec: FeedSpec = FeedSpec()) -> DataFrame:
    """The last change of every price level per bucket and connection epoch.

    Levels combine map-side; the messages themselves are not shuffled here. NULL stands
    for a removed level. One number orders a bucket's changes by message and place in
    it, so value and order are primitives and hash aggregation works.
    """
    left = F.when((F.col("level.size") != 0) | F.col("is_snapshot"), F.col("level.size"))
    nth = F.col("arrival_seq") - F.col("bucket") * F.lit(spec.bucket_rows)
    order = nth * F.lit(1 << 40) + F.col("pos")
    return (
        _bucketed(messages, spec)
        .select(
            "product_id",
            "bucket",
            "conn_epoch",
            "arrival_seq",
            "is_snapshot",
            F.posexplode(F.arrays_zip("is_bid", "price", "size")).alias("pos", "level"),
        )
        .where("level.price IS NOT NULL AND level.size IS NOT NULL")
        .groupBy(
            "product_id",
            "bucket",
            "conn_epoch",
            F.col("level.is_bid").alias("is_bid"),
            F.col("level.price").alias("price"),
        )
        .agg(F.max_by(left, order).alias("size"), F.max("arrival_seq").alias("set_at"))
    )


def level_runs(messages: DataFrame, index: DataFrame, spec: FeedSpec = FeedSpec()) -> DataFrame:
    """Levels that outlive their bucket: set in bucket ``no``, live up to ``until``.

    A level counts if it was set in the running segment: after the last snapshot of its
    bucket and under that book's epoch. It then holds at the start of the following
    buckets until it changes again or the segment ends.
    """
    carried = index.where("reach IS NOT NULL").select(
        "product_id", "bucket", "no", "reach", "last_snap", "epoch_after", "seg_after"
    )
    kept = last_levels(messages, spec).join(carried, ["product_id", "bucket"]).where(
        F.col("conn_epoch").eqNullSafe(F.col("epoch_after"))
        & (F.col("last_snap").isNull() | (F.col("set_at") >= F.col("last_snap")))
    )
    by_level = W.partitionBy("product_id", "seg_after", "is_bid", "price").orderBy("no")
    until = F.coalesce(F.lead("no").over(by_level), F.col("reach"))
    return (
        kept.withColumn("until", until)
        .where("size IS NOT NULL AND until > no")
        .select("product_id", "is_bid", "price", "size", "no", "until")
    )


def chunk_plan(index: DataFrame, runs: DataFrame, spec: FeedSpec = FeedSpec()) -> DataFrame:
    """The chunk of every (product, bucket), balanced by changes and by live levels."""
    steps = runs.select(
        "product_id",
        F.explode(
            F.array(
                F.struct((F.col("no") + 1).alias("no"), F.lit(1).alias("d")),
                F.struct((F.col("until") + 1).alias("no"), F.lit(-1).alias("d")),
            )
        ).alias("step"),
    )
    steps = steps.groupBy("product_id", F.col("step.no").alias("no")).agg(F.sum("step.d").alias("d"))
    so_far = W.partitionBy("product_id").orderBy("no").rowsBetween(W.unboundedPreceding, 0)
    live = index.join(steps, ["product_id", "no"], "left").withColumn(
        "live", F.coalesce(F.sum("d").over(so_far), F.lit(0))
    )
    weight = F.col("changes") / F.greatest(F.lit(spec.chunk_rows), "live")
    before = F.sum("weight").over(so_far) - F.col("weight")
    return (
        live.withColumn("weight", weight)
        .withColumn("chunk", F.floor(before).cast("long"))
        .select("product_id", "bucket", "no", "chunk", "live", "seg_before", "epoch_before")
    )


def opening_books(runs: DataFrame, plan: DataFrame) -> DataFrame:
    """One row per (book_product, book_chunk): the book when the chunk starts.

    A level is in the books of all chunks that start while it is live.
    """
    at = plan.select("product_id", "no", "chunk")
    lasting = (
        runs.join(at, ["product_id", "no"])
        .join(at.select("product_id", F.col("no").alias("until"), F.col("chunk").alias("last")), ["product_id", "until"])
        .where("last > chunk")
        .select(
            "product_id",
            "is_bid",
            "price",
            "size",
            F.explode(F.sequence(F.col("chunk") + 1, F.col("last"))).alias("chunk"),
        )
    )
    books = lasting.groupBy("product_id", "chunk").agg(
        F.collect_list(F.struct("is_bid", "price", "size")).alias("levels")
    )
    starts = plan.groupBy("product_id", "chunk").agg(
        F.min_by(F.struct("seg_before", "epoch_before"), "no").alias("start")
    )
    return starts.join(books, ["product_id", "chunk"], "left").select(
        F.col("product_id").alias("book_product"),
        F.col("chunk").alias("book_chunk"),
        F.col("start.seg_before").alias("segment"),
        F.col("start.epoch_before").alias("epoch"),
        F.col("levels.is_bid").alias("is_bid"),
        F.col("levels.price").alias("price"),
        F.col("levels.size").alias("size"),
    )


def closing_books(messages: DataFrame, tops: DataFrame, spec: FeedSpec = FeedSpec()) -> DataFrame:
    """One row per product: the book when the messages end, as a stream takes it over.

    ``tops`` is the result of ``book_tops`` on the same messages, as a written table; its
    last row of the running segment is what the next order flow is against.
    """
    index = materialize(bucket_index(messages, spec), "book-buckets")
    ends = index.groupBy("product_id").agg(
        F.max("no").alias("no"),
        F.max_by(F.struct("seg_after", "epoch_after"), "no").alias("_end"),
    )
    # A bucket after the last one: what is live when it starts is the closing book.
    last = ends.select("product_id", F.col("_end.seg_after").alias("_seg"), (F.col("no") + 1).alias("until"))
    running = index.drop("reach").join(last, "product_id").where("seg_after = _seg")
    running = running.withColumnRenamed("until", "reach").drop("_seg")
    runs = level_runs(messages, running, spec)
    live = runs.join(last.drop("_seg"), ["product_id", "until"])
    books = live.groupBy("product_id").agg(
        F.collect_list(F.struct("is_bid", "price", "size")).alias("levels")
    )
    seen = messages.groupBy("product_id").agg(F.max("arrival_seq").alias("last_seq"))
    shown = tops.groupBy("product_id").agg(
        F.max_by(F.struct("segment", *TOP_COLUMNS), "arrival_seq").alias("_top")
    )
    current = F.col("_top.segment") == F.col("_end.seg_after")
    return (
        ends.join(seen, "product_id")
        .join(books, "product_id", "left")
        .join(shown, "product_id", "left")
        .select(
            "product_id",
            F.col("_end.seg_after").alias("segment"),
            F.col("_end.epoch_after").alias("epoch"),
            "last_seq",
            F.array(*[F.when(current, F.col(f"_top.{c}")) for c in TOP_COLUMNS]).alias("before"),
            F.col("levels.is_bid").alias("is_bid"),
            F.col("levels.price").alias("price"),
            F.col("levels.size").alias("size"),
        )
    )


def _plain(column: pa.Array) -> list:
    """Python values of a flat column, through NumPy (much faster than boxing)."""
    return column.to_numpy(zero_copy_only=False).tolist()


def flat(lists: pa.ListArray) -> tuple[list, list]:
    """Offsets and values of a list column; a missing number becomes NaN."""
    at = lists.offsets.to_numpy()
    return (at - at[0]).tolist(), _plain(lists.flatten())


def _replayer(depth: int):
    """Chunk replay: (messages of a chunk, its opening book) -> tops."""
    out_schema = pa.schema(
        [
            ("product_id", pa.string()),
            ("arrival_seq", pa.int64()),
            ("segment", pa.int64()),
            ("ts_ms", pa.int64()),
            ("best_bid", pa.float64()),
            ("best_bid_qty", pa.float64()),
            ("best_ask", pa.float64()),
            ("best_ask_qty", pa.float64()),
            ("bid_depth5", pa.float64()),
            ("ask_depth5", pa.float64()),
            ("conn_epoch", pa.int64()),
            ("ofi_delta", pa.float64()),
            ("chunk_first", pa.bool_()),
            ("chunk_last", pa.bool_()),
        ]
    )

    def run(key, messages: pa.Table, opening: pa.Table) -> pa.Table:
        book = Replay(depth)
        start = opening.to_pylist()[0]
        segment, book_epoch = start["segment"], start["epoch"]
        book.apply(False, start["is_bid"] or (), start["price"] or (), start["size"] or ())
        product = key[0].as_py()
        tops = []
        before = None
        opened = False
        snapshot_here = False
        ordered = messages.sort_by("arrival_seq")
        # Batch by batch: only Arrow buffers hold the whole chunk.
        for batch in ordered.to_batches(max_chunksize=8192):
            at, prices = flat(batch.column("price"))
            at_size, sizes = flat(batch.column("size"))
            at_side, sides = flat(batch.column("is_bid"))
            rows = zip(
                batch.column("arrival_seq").to_numpy().tolist(),
                batch.column("ts_ms").to_pylist(),
                batch.column("conn_epoch").to_pylist(),
                _plain(batch.column("is_snapshot")),
            )
            for i, (seq, ts_ms, epoch, snap) in enumerate(rows):
                if snap:
                    segment += 1
                    book_epoch = epoch
                    before, snapshot_here = None, True
                elif epoch != book_epoch:
                    continue
                book.apply(
                    snap,
                    sides[at_side[i] : at_side[i + 1]],
                    prices[at[i] : at[i + 1]],
                    sizes[at_size[i] : at_size[i + 1]],
                )
                top = book.top()
                if top is None:
                    continue
                now = top[:4]
                # Without a snapshot in this chunk the first top follows one of
                # an earlier chunk, which is filled in afterwards.
                if before is not None:
                    flow = flow_delta(before, now)
                elif snapshot_here:
                    flow = 0.0
                else:
                    flow, opened = None, True
                before = now
                shown = -1 if book_epoch is None else book_epoch
                tops.append((seq, segment, ts_ms, *top, shown, flow))
        n = len(tops)
        columns = [
            [product] * n,
            *(list(zip(*tops)) or [()] * (len(out_schema) - 3)),
            [i == 0 and opened for i in range(n)],
            # The last top leads into a later chunk unless the book was reset.
            [i == n - 1 and before is not None for i in range(n)],
        ]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, out_schema)], out_schema)

    return run


def replay(messages: DataFrame, spec: FeedSpec = FeedSpec()) -> DataFrame:
    """Tops of book per applied message; ``ofi_delta`` is NULL on chunk openers.

    The index of buckets, the levels that outlive theirs and the plan of chunks are
    written first: they are small, used twice, and their real size then decides how they
    are joined. Where the plan can be broadcast, messages are shuffled once, by chunk.
    """
    index = materialize(bucket_index(messages, spec), "book-buckets")
    runs = materialize(level_runs(messages, index, spec), "book-levels")
    plan = materialize(chunk_plan(index, runs, spec), "book-plan")
    chunks = _bucketed(messages, spec).join(
        plan.select("product_id", "bucket", "chunk"), ["product_id", "bucket"]
    )
    chunks = chunks.select(
        "product_id",
        "chunk",
        "arrival_seq",
        iso_millis("time").alias("ts_ms"),
        "conn_epoch",
        "is_snapshot",
        "is_bid",
        "price",
        "size",
    )
    return (
        chunks.groupBy("product_id", "chunk")
        .cogroup(opening_books(runs, plan).groupBy("book_product", "book_chunk"))
        .applyInArrow(_replayer(spec.depth_levels), schemas.BOOK_TOP)
    )


def close_flow(tops: DataFrame) -> DataFrame:
    """Fill the flow of chunk openers from the last top of an earlier chunk.

    ``tops`` is read twice, so pass a written table. Only one or two rows per
    chunk take part in the ordered step; all others pass straight through.
    """
    w = W.partitionBy("product_id", "segment").orderBy("arrival_seq")
    names = dict(zip(("bid", "bid_qty", "ask", "ask_qty"), TOP_COLUMNS, strict=True))
    edges = tops.where("chunk_first OR chunk_last")
    linked = edges.withColumns({f"_p_{c}": F.lag(c).over(w) for c in TOP_COLUMNS})
    flow = order_flow(
        {k: F.col(c) for k, c in names.items()},
        {k: F.col(f"_p_{c}") for k, c in names.items()},
    )
    openers = linked.where("chunk_first").withColumn(
        "ofi_delta", F.when(F.col("_p_best_bid").isNull(), F.lit(0.0)).otherwise(flow)
    )
    return (
        tops.where("NOT chunk_first")
        .unionByName(openers.select(*tops.columns))
        .drop("chunk_first", "chunk_last")
    )


def finish_tops(tops: DataFrame) -> DataFrame:
    """Mid, spread and event time from the bare top."""
    bid, ask = F.col("best_bid"), F.col("best_ask")
    return tops.withColumns(
        {"mid": mid(bid, ask), "spread": ask - bid, "event_ts": millis_time("ts_ms")}
    )


def book_tops(messages: DataFrame, spec: FeedSpec = FeedSpec()) -> DataFrame:
    """Top of book and order-flow imbalance after every applied message."""
    return finish_tops(close_flow(materialize(replay(messages, spec), "book-tops")))
