"""Declared schemas. Nothing is inferred from data.

Field names and their order are fixed values of the feed and table contracts.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _L, _D, _B, _TS = (
    T.StringType(),
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
    T.TimestampNTZType(),
)

# Every feed field is read as text in one JSON pass; typing happens per route.
FEED_FIELDS = (
    "type",
    "product_id",
    "trade_id",
    "price",
    "size",
    "side",
    "time",
    "last_trade_id",
    "message",
    "reason",
    "bids",
    "asks",
    "changes",
)
CORRUPT = "_corrupt"
FEED_JSON = _struct(*[(name, _S) for name in FEED_FIELDS], (CORRUPT, _S))

RAW_MESSAGE = _struct(("value", _S), ("arrival_seq", _L), ("conn_epoch", _L), ("ingest_ts", _S))

TRADE = _struct(
    ("type", _S),
    ("product_id", _S),
    ("trade_id", _L),
    ("price", _S),
    ("size", _S),
    ("side", _S),
    ("time", _S),
    ("conn_epoch", _L),
    ("arrival_seq", _L),
)

BOOK_TOP = _struct(
    ("product_id", _S),
    ("arrival_seq", _L),
    ("segment", _L),
    ("ts_ms", _L),
    ("best_bid", _D),
    ("best_bid_qty", _D),
    ("best_ask", _D),
    ("best_ask_qty", _D),
    ("bid_depth5", _D),
    ("ask_depth5", _D),
    ("conn_epoch", _L),
    ("ofi_delta", _D),
    ("chunk_first", _B),
    ("chunk_last", _B),
)

TRADE_BAR = _struct(
    ("product_id", _S),
    ("bar_ts", _TS),
    ("trade_count", _L),
    ("volume", _D),
    ("notional", _D),
    ("maker_buy_volume", _D),
    ("maker_sell_volume", _D),
    ("price_min", _D),
    ("price_max", _D),
)

BOOK_BAR = _struct(
    ("product_id", _S),
    ("bar_ts", _TS),
    ("mid_close", _D),
    ("mid_min", _D),
    ("mid_max", _D),
    ("spread_mean", _D),
    ("spread_max", _D),
    ("bid_depth5_mean", _D),
    ("ask_depth5_mean", _D),
    ("ofi_sum", _D),
    ("updates", _L),
    ("conn_epoch_max", _L),
)

GOLD = _struct(
    ("product_id", _S),
    ("as_of_ts", _TS),
    ("label_ts", _TS),
    ("rv_1m", _D),
    ("rv_5m", _D),
    ("rv_15m", _D),
    ("rv_60m", _D),
    ("ofi_5m", _D),
    ("spread_mean_5m", _D),
    ("spread_max_5m", _D),
    ("depth_imb_5m", _D),
    ("trade_count_5m", _L),
    ("volume_5m", _D),
    ("notional_5m", _D),
    ("taker_imb_5m", _D),
    ("bar_count_5m", _L),
    ("label_rv_5m", _D),
    ("label_bar_count", _L),
    ("built_at", _TS),
)

#: How far a gold table is built, per product: the next grid step, the newest bar seen,
#: the bar that the next build's first return starts from, and the rows so far.
PROGRESS = _struct(
    ("product_id", _S),
    ("next_step", _L),
    ("bars_to", _TS),
    ("base_ts", _TS),
    ("base_mid", _D),
    ("rows", _L),
)

FEATURES = (
    "rv_1m",
    "rv_5m",
    "rv_15m",
    "rv_60m",
    "ofi_5m",
    "spread_mean_5m",
    "spread_max_5m",
    "depth_imb_5m",
    "trade_count_5m",
    "volume_5m",
    "notional_5m",
    "taker_imb_5m",
)
HAR_FEATURES = ("rv_1m", "rv_5m", "rv_15m", "rv_60m")
LABEL = "label_rv_5m"

PREDICTION = _struct(
    ("product_id", _S),
    ("as_of_ts", _TS),
    ("label_ts", _TS),
    ("pred_rv", _D),
    ("pred_persistence", _D),
    ("model_version", _S),
    ("features", _S),
    ("created_at", _TS),
)


#: Realised volatility of a prediction, and when it was known; the first one stays.
LABEL_ROW = _struct(
    ("product_id", _S),
    ("as_of_ts", _TS),
    ("label_rv", _D),
    ("labeled_at", _TS),
)


def with_day(schema: T.StructType, name: str) -> T.StructType:
    """A copy of ``schema`` with a day partition column."""
    return T.StructType([*schema.fields, T.StructField(name, T.DateType(), True)])
