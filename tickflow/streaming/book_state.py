"""Order books as keyed streaming state.

A live book is inherently sequential per product; the source limits how many
messages one batch holds, and backfills use ``operators.book`` instead.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tickflow.operators.book import Replay, Side, flat, flow_delta
from tickflow.streaming.sorted_runs import in_order

# What a book needs of a message; Arrow holds a message in about a hundred bytes.
_MESSAGE = pa.schema(
    [
        ("arrival_seq", pa.int64()),
        ("event_ts", pa.timestamp("us")),
        ("conn_epoch", pa.int64()),
        ("is_snapshot", pa.bool_()),
        ("is_bid", pa.list_(pa.bool_())),
        ("price", pa.list_(pa.float64())),
        ("size", pa.list_(pa.float64())),
    ]
)
_LEVEL_KEY = T.StructType([T.StructField("rank", T.DoubleType())])
_LEVEL = T.StructType([T.StructField("size", T.DoubleType())])
_META = T.StructType(
    [T.StructField("epoch", T.LongType())]
    + [T.StructField(n, T.DoubleType()) for n in ("bid", "bid_qty", "ask", "ask_qty")]
    + [T.StructField("segment", T.LongType()), T.StructField("last_seq", T.LongType())]
    + [T.StructField("disorder", T.LongType()), T.StructField("dropped", T.LongType())]
)


def packed(books: DataFrame) -> DataFrame:
    """Rows of ``operators.book.closing_books`` as initial state: a product and a JSON text.

    A batch's messages carry the columns of the initial state along, as NULLs. List columns
    of NULLs are gone through from the batch's start at every message, flat ones are not.
    """
    rest = [c for c in books.columns if c != "product_id"]
    return books.select("product_id", F.to_json(F.struct(*rest)).alias("book"))


class BookState(StatefulProcessor):
    """Applies messages in arrival order and writes only changed levels back."""

    output = T.StructType(
        [
            T.StructField("product_id", T.StringType()),
            T.StructField("arrival_seq", T.LongType()),
            T.StructField("segment", T.LongType()),
            T.StructField("event_ts", T.TimestampType()),
            *[
                T.StructField(n, T.DoubleType())
                for n in (
                    "best_bid",
                    "best_bid_qty",
                    "best_ask",
                    "best_ask_qty",
                    "bid_depth5",
                    "ask_depth5",
                    "ofi_delta",
                )
            ],
            T.StructField("conn_epoch", T.LongType()),
            # Messages that arrived out of order, and stale deltas, so far.
            T.StructField("disorder", T.LongType()),
            T.StructField("dropped", T.LongType()),
        ]
    )

    def __init__(self, depth: int):
        self.depth = depth

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bids = handle.getMapState("bids", _LEVEL_KEY, _LEVEL)
        self.asks = handle.getMapState("asks", _LEVEL_KEY, _LEVEL)
        self.meta = handle.getValueState("meta", _META)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """Take over a book that a batch has built (a row of ``packed``)."""
        row = json.loads(initialState["book"].iloc[0])
        levels = zip(*(row.get(n) or () for n in ("is_bid", "price", "size")))
        for is_bid, price, size in levels:
            state, sign = (self.bids, -1) if is_bid else (self.asks, 1)
            state.updateValue((sign * float(price),), (float(size),))
        before = [None if x is None else float(x) for x in row["before"]]
        self.meta.update((row.get("epoch"), *before, row["segment"], row["last_seq"], 0, 0))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        book = Replay(self.depth)
        self._load(book.bids, self.bids)
        self._load(book.asks, self.asks)
        stored = self.meta.get() if self.meta.exists() else None
        epoch, before, segment, last_seq, disorder, dropped = None, None, 0, None, 0, 0
        if stored is not None:
            epoch, segment, last_seq = stored[0], stored[5], stored[6]
            disorder, dropped = stored[7], stored[8]
            before = tuple(stored[1:5]) if stored[1] is not None else None
        fresh, touched = False, set()
        messages = (
            pa.Table.from_pandas(frame[_MESSAGE.names], _MESSAGE, preserve_index=False)
            for frame in rows
        )
        for block in in_order(messages, "arrival_seq"):
            columns = {n: block[n].combine_chunks() for n in block.column_names}
            clock = columns["event_ts"].to_numpy(zero_copy_only=False)
            at, prices = flat(columns["price"])
            at_size, sizes = flat(columns["size"])
            at_side, sides = flat(columns["is_bid"])
            out, shown_at = [], []
            heads = [columns[n].to_pylist() for n in ("arrival_seq", "conn_epoch", "is_snapshot")]
            for i, (seq, own, snap) in enumerate(zip(*heads)):
                if last_seq is not None and seq < last_seq:
                    disorder += 1
                last_seq = seq if last_seq is None else max(last_seq, seq)
                if snap:
                    epoch, before, fresh = own, None, True
                    segment += 1
                    touched.clear()
                elif own != epoch:
                    dropped += 1
                    continue
                price = prices[at[i] : at[i + 1]]
                side = sides[at_side[i] : at_side[i + 1]]
                book.apply(snap, side, price, sizes[at_size[i] : at_size[i + 1]])
                touched.update(level for level in zip(side, price) if level[1] == level[1])
                top = book.top()
                if top is None:
                    continue
                flow = 0.0 if before is None else flow_delta(before, top[:4])
                before = top[:4]
                shown = -1 if epoch is None else epoch
                shown_at.append(i)
                out.append((key[0], seq, segment, None, *top, flow, shown, disorder, dropped))
            if out:
                tops = pd.DataFrame(out, columns=self.output.names)
                yield tops.assign(event_ts=clock[shown_at])
        self._store(book.bids, self.bids, fresh, [p for bid, p in touched if bid])
        self._store(book.asks, self.asks, fresh, [p for bid, p in touched if not bid])
        self.meta.update(
            (epoch, *(before or (None,) * 4), segment, last_seq, disorder, dropped)
        )

    def close(self) -> None:
        pass

    @staticmethod
    def _load(side: Side, state) -> None:
        for (rank,), (size,) in state.iterator():
            side.put(side.sign * rank, size)

    @staticmethod
    def _store(side: Side, state, fresh: bool, prices: list[float]) -> None:
        if fresh:
            state.clear()
            for rank, size in side.sizes.items():
                state.updateValue((rank,), (size,))
            return
        for price in prices:
            if price != price:
                continue
            rank = side.sign * price
            if rank in side.sizes:
                state.updateValue((rank,), (side.sizes[rank],))
            else:
                state.removeKey((rank,))
