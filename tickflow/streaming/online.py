"""Online features: the gold features of a live stream of bars.

Both bar streams are one keyed state per product. A grid point is due once the
watermark, which is the smaller of both streams' high-water marks, has passed
it by the safety margin; an event-time timer per point does the waiting.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tickflow import schemas
from tickflow.operators import bars
from tickflow.spec import BarSpec, FeedSpec

_BOOK = ("mid_close", "spread_mean", "spread_max", "bid_depth5_mean", "ask_depth5_mean", "ofi_sum")
_TRADE = ("trade_count", "volume", "notional", "maker_buy_volume", "maker_sell_volume")


def _doubles(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


class _Series:
    """Bars of one product by time, mirrored in map state; the last write wins."""

    def __init__(self, state):
        self.state = state
        self.rows: dict[int, tuple] = {k[0]: tuple(v) for k, v in state.iterator()}
        self.times: list[int] = sorted(self.rows)

    def put(self, at: int, row: tuple) -> None:
        if at not in self.rows:
            insort(self.times, at)
        self.rows[at] = row
        self.state.updateValue((at,), row)

    def span(self, lo: int, hi: int) -> list[int]:
        """Times in (lo, hi]."""
        return self.times[bisect_right(self.times, lo) : bisect_right(self.times, hi)]

    def prune(self, before: int, keep: int = 0) -> None:
        """Forget rows before a time, but for the last ``keep`` of them."""
        end = max(bisect_left(self.times, before) - keep, 0)
        for at in self.times[:end]:
            del self.rows[at]
            self.state.removeKey((at,))
        del self.times[:end]


class OnlineFeatures(StatefulProcessor):
    """Emits one feature row per product and due grid point, in order, once."""

    output = T.StructType(
        [
            T.StructField("product_id", T.StringType()),
            T.StructField("as_of_ts", T.TimestampType()),
            *[T.StructField(c, T.DoubleType()) for c in schemas.FEATURES],
            T.StructField("bar_count_5m", T.LongType()),
        ]
    )

    def __init__(self, spec: BarSpec, feed: FeedSpec):
        self.spec = spec
        self.feed = feed

    def init(self, handle: StatefulProcessorHandle) -> None:
        at = T.StructType([T.StructField("at", T.LongType())])
        self.handle = handle
        self.book_state = handle.getMapState("book", at, _doubles(_BOOK))
        self.trade_state = handle.getMapState("trade", at, _doubles(_TRADE))
        self.done = handle.getValueState("done", at)
        self.loaded: dict[str, tuple[_Series, _Series]] = {}

    def _series(self, product: str) -> tuple[_Series, _Series]:
        if product not in self.loaded:
            self.loaded[product] = (_Series(self.book_state), _Series(self.trade_state))
        return self.loaded[product]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        book, trade = self._series(key[0])
        last = self.done.get()[0] if self.done.exists() else None
        step_ms = self.spec.step_seconds * 1000
        due = set()
        for frame in rows:
            for stream, names, series in (("book", _BOOK, book), ("trade", _TRADE, trade)):
                part = frame[frame["stream"] == stream]
                at = (part["bar_ts"].astype("datetime64[ms]").astype("int64")).tolist()
                values = part[list(names)].astype(float).itertuples(index=False, name=None)
                for ms, row in zip(at, values):
                    series.put(ms, row)
                    point = ms - ms % step_ms
                    if stream == "book" and (last is None or point > last):
                        due.add(point)
        margin = self.feed.sync_margin_seconds * 1000
        for point in due:
            self.handle.registerTimer(point + margin)
        yield pd.DataFrame(columns=self.output.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        margin = self.feed.sync_margin_seconds * 1000
        point = expiredTimerInfo.getExpiryTimeInMs() - margin
        book, trade = self._series(key[0])
        found = self._features(book, trade, point)
        if found is None:
            yield pd.DataFrame(columns=self.output.names)
            return
        self.done.update((point,))
        # Always relative to the emitted point: one stream may be far ahead.
        # The next window, and a step to spare.
        cutoff = point - (self.spec.history + 2) * self.spec.step_seconds * 1000
        book.prune(cutoff, keep=1)
        trade.prune(cutoff)
        row = (key[0], pd.Timestamp(point, unit="ms"), *found)
        yield pd.DataFrame([row], columns=self.output.names)

    def close(self) -> None:
        pass

    def _features(self, book: _Series, trade: _Series, point: int):
        """Feature values at a point, or None without any usable bar."""
        step = self.spec.step_seconds * 1000
        lo = {h: point - h * step for h in self.spec.horizons}
        times = book.span(point - self.spec.history * step, point)
        recent = book.span(point - self.spec.flow_horizon * step, point)
        if not recent:
            return None
        first = bisect_left(book.times, times[0])
        previous = book.rows[book.times[first - 1]][0] if first else None
        squares = dict.fromkeys(lo, None)
        for at in times:
            mid = book.rows[at][0]
            if previous is not None and previous > 0 and mid > 0:
                ret2 = math.log(mid / previous) ** 2
                for h, start in lo.items():
                    if at > start:
                        squares[h] = ret2 + (squares[h] or 0.0)
            previous = mid
        if not squares[self.spec.history]:
            return None
        bars_in = [book.rows[at] for at in recent]
        n = len(bars_in)
        spread, bid, ask, ofi = (sum(b[i] for b in bars_in) for i in (1, 3, 4, 5))
        trades = [trade.rows[at] for at in trade.span(point - self.spec.flow_horizon * step, point)]
        count, volume, notional, buys, sells = (
            float(sum(t[i] for t in trades)) for i in range(len(_TRADE))
        )
        return (
            *[None if squares[h] is None else math.sqrt(squares[h]) for h in self.spec.horizons],
            ofi,
            spread / n,
            max(b[2] for b in bars_in),
            (bid - ask) / (bid + ask) if bid + ask else None,
            count,
            volume,
            notional,
            (sells - buys) / volume if volume else None,
            n,
        )


class IdleOnlineFeatures(OnlineFeatures):
    """The same rows where a side may fall silent.

    A product's point is due once both of its own streams are past it by the margin. A
    side without a bar for ``idle_seconds`` of the machine's clock is idle and not waited
    for; processing-time timers do the looking. Points come out in order and once, so a
    side that wakes up only counts for points that are still to come.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        seen = T.StructType(
            [T.StructField(n, T.LongType()) for n in ("book_high", "book_at", "trade_high", "trade_at")]
        )
        self.seen = handle.getValueState("seen", seen)

    def _due(self, book: _Series, upto: int, last: int | None) -> list[int]:
        """Points with book bars after the last one put out, at or before ``upto``."""
        step_ms = self.spec.step_seconds * 1000
        points = {at - at % step_ms for at in book.times}
        return sorted(p for p in points if p <= upto and (last is None or p > last))

    def _emit(self, key, now: int) -> pd.DataFrame:
        book, trade = self._series(key[0])
        idle_ms, margin = self.feed.idle_seconds * 1000, self.feed.sync_margin_seconds * 1000
        book_high, book_at, trade_high, trade_at = self.seen.get()
        sides = [(h, t) for h, t in ((book_high, book_at), (trade_high, trade_at))]
        live = [h for h, t in sides if now - t < idle_ms]
        # With both silent, what has come in is all there is for now.
        upto = min(live) if live else max(h for h, _ in sides)
        last = self.done.get()[0] if self.done.exists() else None
        out = []
        for point in self._due(book, upto - margin, last):
            found = self._features(book, trade, point)
            if found is not None:
                out.append((key[0], pd.Timestamp(point, unit="ms"), *found))
            self.done.update((point,))
            last = point
        if last is not None:
            cutoff = last - (self.spec.history + 2) * self.spec.step_seconds * 1000
            book.prune(cutoff, keep=1)
            trade.prune(cutoff)
        newest = book.times[-1] if book.times else None
        if newest is not None and (last is None or newest - newest % (self.spec.step_seconds * 1000) > last):
            waits = [t + idle_ms for _, t in sides if now - t < idle_ms]
            if waits:
                self.handle.registerTimer(min(waits) + 1)
        return pd.DataFrame(out, columns=self.output.names)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        book, trade = self._series(key[0])
        # A stream that never delivered counts from the first look at the product.
        high = list(self.seen.get()) if self.seen.exists() else [-(2**62), now, -(2**62), now]
        for frame in rows:
            for i, stream, names, series in ((0, "book", _BOOK, book), (2, "trade", _TRADE, trade)):
                part = frame[frame["stream"] == stream]
                at = (part["bar_ts"].astype("datetime64[ms]").astype("int64")).tolist()
                values = part[list(names)].astype(float).itertuples(index=False, name=None)
                for ms, row in zip(at, values):
                    series.put(ms, row)
                if at:
                    high[i : i + 2] = [max(high[i], *at), now]
        self.seen.update(tuple(high))
        yield self._emit(key, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield self._emit(key, timerValues.getCurrentProcessingTimeInMs())


def _wide(book_bars: DataFrame, trade_bars: DataFrame) -> DataFrame:
    return bars.tagged_bars(book_bars, trade_bars).select(
        "product_id",
        "bar_ts",
        "stream",
        *[F.col(c).cast("double").alias(c) for c in (*_BOOK, *_TRADE)],
    )


def idle_online_features(
    book_bars: DataFrame,
    trade_bars: DataFrame,
    spec: BarSpec = BarSpec(),
    feed: FeedSpec = FeedSpec(),
) -> DataFrame:
    """Feature rows from two streams of bars of which one may fall silent.

    Unlike ``online_features`` a product waits for its own streams alone, for at most
    ``feed.idle_seconds`` after the last bar of a side, and no bar is dropped as late: one
    that comes after its points are out is kept for later points.
    """
    return _wide(book_bars, trade_bars).groupBy("product_id").transformWithStateInPandas(
        IdleOnlineFeatures(spec, feed),
        outputStructType=IdleOnlineFeatures.output,
        outputMode="Append",
        timeMode="ProcessingTime",
    )


def online_features(
    book_bars: DataFrame,
    trade_bars: DataFrame,
    spec: BarSpec = BarSpec(),
    feed: FeedSpec = FeedSpec(),
    delay: str | None = None,
) -> DataFrame:
    """Feature rows from two streams of bars (bar_ts as TIMESTAMP).

    ``delay`` is how far a product's bars may lie behind the newest ones of any product
    (``feed.watermark`` if not given); Spark drops bars that are later than that, and
    points come out that much later.

    Set ``spark.sql.streaming.multipleWatermarkPolicy`` to ``min`` (the
    default): a point is due only when both streams are past it.
    """
    delay = delay or feed.watermark
    wide = _wide(
        book_bars.withWatermark("bar_ts", delay), trade_bars.withWatermark("bar_ts", delay)
    )
    return wide.groupBy("product_id").transformWithStateInPandas(
        OnlineFeatures(spec, feed),
        outputStructType=OnlineFeatures.output,
        outputMode="Append",
        timeMode="EventTime",
    )
