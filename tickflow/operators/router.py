"""Raw feed messages: one JSON pass, one route per message, nothing dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow import schemas
from tickflow.functions.clock import trade_event_time
from tickflow.functions.flow import number
from tickflow.spec import FeedSpec

# Fixed values of the feed format.
TRADE_TYPES = ("match", "last_match")
BOOK_TYPES = ("snapshot", "l2update")
INVALID_JSON = "invalid json: "
MISSING_PRODUCT = "missing product_id in "
FEED_ERROR = "feed error: "
UNRECOGNIZED = "unrecognized type: "
UNKNOWN_KEY = "unknown"
UNREADABLE = "unreadable levels in "
NO_OBJECT = "not a JSON object"
MALFORMED = "malformed"


_JSON = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
#: Blanks that JSON allows around a value.
BLANKS = " \t\r\n"
#: An object without another brace: where it parses, nothing can follow it.
PLAIN_OBJECT = r"^[ \t\r\n]*\{[^{}]*\}[ \t\r\n]*$"
#: Text of ids that may stand for nothing: false, a zero, an empty list or object.
FALSY = r"^(false|-?0+(\.0*)?([eE][+-]?[0-9]+)?|\[\s*\]|\{\s*\})$"


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is worked out once per row, however often it is read later on.

    A plain column is copied into every expression that reads it, and into filters that
    move below it. Nothing moves below a generator.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def parse(raw: DataFrame) -> DataFrame:
    """Add ``msg``: every known field as text plus the corrupt marker.

    ``value`` stays untouched, so fields nobody declared here survive.
    """
    options = _JSON | {"columnNameOfCorruptRecord": schemas.CORRUPT}
    return once(raw, "msg", F.from_json("value", schemas.FEED_JSON, options))


def _is_json() -> Column:
    """One JSON value and nothing after it.

    The parser itself stops at a value's end. In an array it sees whatever follows; a text
    that closes the array early has as many elements with a null after it as without.
    """

    def size(end: str) -> Column:
        listed = F.concat(F.lit("["), "value", F.lit(end))
        return F.coalesce(F.size(F.from_json(listed, "array<string>", _JSON)), F.lit(-1))

    return (size("]") == 1) & (size(",null]") == 2)


def _fault() -> Column:
    """Why a message is no object; NULL for objects. Most need no second parse."""
    opened = F.ltrim("value", F.lit(BLANKS)).startswith("{")
    parsed = F.col(f"msg.{schemas.CORRUPT}").isNull() & opened
    return (
        F.when(F.col("value").isNull(), F.lit(MALFORMED))
        .when(parsed & F.col("value").rlike(PLAIN_OBJECT), F.lit(None))
        .when(~_is_json(), F.lit(MALFORMED))
        .when(~opened, F.lit(NO_OBJECT))
    )


def _product() -> Column:
    """The product id, NULL where it is missing, empty, zero or false.

    Fields are read as text; only an id whose text may stand for nothing is looked at
    again, as a string such as "0" is an id like any other.
    """
    text = F.nullif(F.col("msg.product_id"), F.lit(""))
    typed = F.expr("to_json(try_variant_get(try_parse_json(value), '$.product_id', 'variant'))")
    quoted = F.coalesce(typed.startswith('"'), F.lit(False))
    return F.when(text.rlike(FALSY) & ~quoted, F.lit(None)).otherwise(text)


def route(raw: DataFrame) -> DataFrame:
    """Classify into trades / book / heartbeat / control / dlq, with a reason.

    In: value, arrival_seq, conn_epoch, ingest_ts (the envelope). Out: the same
    plus msg, route and error. What is no JSON object has no ``msg``.
    """
    sound = F.col("_seen.fault").isNull()
    kind = F.when(sound, F.col("msg.type"))
    product = F.when(sound, F.col("_seen.product"))
    keyed = kind.isin(*TRADE_TYPES, *BOOK_TYPES)
    error = (
        F.when(F.col("_fault").isNotNull(), F.concat(F.lit(INVALID_JSON), "_fault"))
        .when(keyed & F.col("_product").isNull(), F.concat(F.lit(MISSING_PRODUCT), kind))
        .when(
            kind == "error",
            F.concat(
                F.lit(FEED_ERROR),
                F.coalesce("msg.message", F.lit("None")),
                F.lit(" "),
                F.coalesce("msg.reason", F.lit("")),
            ),
        )
        .when(
            kind.isNull() | ~(keyed | kind.isin("heartbeat", "subscriptions")),
            F.concat(
                F.lit(UNRECOGNIZED),
                F.coalesce(F.concat(F.lit("'"), kind, F.lit("'")), F.lit("None")),
            ),
        )
    )
    target = (
        F.when(F.col("error").isNotNull(), F.lit("dlq"))
        .when(kind.isin(*TRADE_TYPES), F.lit("trades"))
        .when(kind.isin(*BOOK_TYPES), F.lit("book"))
        .when(kind == "heartbeat", F.lit("heartbeat"))
        .otherwise(F.lit("control"))
    )
    seen = once(parse(raw), "_seen", F.struct(_fault().alias("fault"), _product().alias("product")))
    known = seen.withColumns({"_fault": F.col("_seen.fault"), "_kind": kind, "_product": product})
    return (
        known.withColumn("error", error)
        .withColumn("route", target)
        .withColumn("msg", F.when(sound, F.col("msg").withField("product_id", F.col("_product"))))
        .select(*raw.columns, "msg", "error", "route")
    )


def envelope(raw: DataFrame, conn_epoch: Column, ingest_ts: Column) -> DataFrame:
    """Attach the connection epoch and the ingest clock to raw messages."""
    return raw.withColumns({"conn_epoch": conn_epoch.cast("long"), "ingest_ts": ingest_ts})


def dead_letters(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("route") == "dlq").select(
        "arrival_seq", F.col("value").alias("raw"), "error", "ingest_ts"
    )


def oversize_letter(spec: FeedSpec = FeedSpec()) -> Column:
    """(error, raw) of a message over the limit: the size, and a truncated copy."""
    size = F.octet_length("value").cast("string")
    head = F.decode(F.substring(F.encode("value", "UTF-8"), 1, spec.truncated_bytes), "UTF-8")
    return F.struct(
        F.concat(F.lit("message too large ("), size, F.lit(" bytes) for "), "route").alias(
            "error"
        ),
        F.concat(head, F.lit("...")).alias("raw"),
    )


def oversize_letters(routed: DataFrame, spec: FeedSpec = FeedSpec()) -> DataFrame:
    """Messages over the size limit, as dead letters."""
    big = F.octet_length("value") > spec.max_message_bytes
    return (
        routed.where(F.col("route").isin("trades", "book") & big)
        .withColumn("letter", oversize_letter(spec))
        .select("arrival_seq", "ingest_ts", "letter.*")
    )


def product_key(routed: DataFrame) -> Column:
    """The ordering key of a message, also for messages that have none."""
    return F.coalesce("msg.product_id", F.lit(UNKNOWN_KEY))


def allow_products(routed: DataFrame, products: Sequence[str]) -> DataFrame:
    """Keep subscribed products; messages that carry no product pass."""
    product = F.col("msg.product_id")
    return routed.where(product.isNull() | product.isin(*products))


def split_products(text: str) -> tuple[str, ...]:
    """A comma-separated product list from configuration."""
    return tuple(p.strip() for p in text.split(",") if p.strip())


def trades(routed: DataFrame) -> DataFrame:
    """Typed trade rows; ids that are no integers become NULL."""
    return routed.where(F.col("route") == "trades").select(
        F.col("msg.type").alias("type"),
        F.col("msg.product_id").alias("product_id"),
        F.expr("try_cast(msg.trade_id AS BIGINT)").alias("trade_id"),
        F.col("msg.price").alias("price"),
        F.col("msg.size").alias("size"),
        F.col("msg.side").alias("side"),
        F.col("msg.time").alias("time"),
        "conn_epoch",
        "arrival_seq",
    )


def matches(trade_rows: DataFrame) -> DataFrame:
    """Bar input: `match` only, typed, with the trade clock.

    ``last_match`` repeats a trade after a reconnect, so it is routed but never
    counted into a bar.
    """
    return trade_rows.where(F.col("type") == "match").select(
        "product_id",
        "trade_id",
        number("price").alias("price"),
        number("size").alias("size"),
        "side",
        trade_event_time("time").alias("event_ts"),
        "conn_epoch",
        "arrival_seq",
    )


def heartbeats(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("route") == "heartbeat").select(
        F.col("msg.product_id").alias("product_id"),
        F.expr("try_cast(msg.last_trade_id AS BIGINT)").alias("last_trade_id"),
        "arrival_seq",
    )


def book_messages(routed: DataFrame) -> DataFrame:
    """Typed book rows: price levels as three parallel arrays per message."""
    text_rows = "array<array<string>>"
    book = routed.where(F.col("route") == "book").select(
        F.col("msg.type").alias("type"),
        F.col("msg.product_id").alias("product_id"),
        F.coalesce(F.nullif(F.col("msg.time"), F.lit("")), F.col("ingest_ts")).alias("time"),
        "conn_epoch",
        "arrival_seq",
        F.from_json("msg.bids", text_rows).alias("bids"),
        F.from_json("msg.asks", text_rows).alias("asks"),
        F.from_json("msg.changes", text_rows).alias("changes"),
    )
    return book_levels(book)


def book_levels(book: DataFrame) -> DataFrame:
    """Unify snapshots and deltas into (is_bid, price, size) arrays.

    Text that is no number yields a NULL price or size; the fold skips it.
    """
    none = F.array().cast("array<array<string>>")

    def field(rows: Column, at: int) -> Column:
        return F.transform(rows, lambda r: F.get(r, F.lit(at)))

    def numbers(rows: Column) -> Column:
        return F.transform(rows, lambda x: x.try_cast("double"))

    snap = F.col("type") == "snapshot"
    bids = F.coalesce("bids", none)
    asks = F.coalesce("asks", none)
    deltas = F.coalesce("changes", none)
    sides = F.concat(
        F.transform(bids, lambda _: F.lit(True)), F.transform(asks, lambda _: F.lit(False))
    )
    return book.select(
        "product_id",
        "arrival_seq",
        "time",
        "conn_epoch",
        snap.alias("is_snapshot"),
        F.when(snap, sides)
        .otherwise(F.transform(deltas, lambda r: F.get(r, F.lit(0)).eqNullSafe(F.lit("buy"))))
        .alias("is_bid"),
        numbers(F.when(snap, field(F.concat(bids, asks), 0)).otherwise(field(deltas, 1))).alias(
            "price"
        ),
        numbers(F.when(snap, field(F.concat(bids, asks), 1)).otherwise(field(deltas, 2))).alias(
            "size"
        ),
    )


def unreadable_levels(routed: DataFrame) -> DataFrame:
    """Book messages with price levels that are no numbers, as dead letters.

    The book goes on with a message's other levels.
    """
    text_rows = "array<array<string>>"
    book = routed.where(F.col("route") == "book").select(
        "arrival_seq",
        F.col("value").alias("raw"),
        F.col("msg.type").alias("type"),
        "ingest_ts",
        *[F.from_json(f"msg.{c}", text_rows).alias(c) for c in ("bids", "asks", "changes")],
    )
    none = F.array().cast(text_rows)
    snap = F.col("type") == "snapshot"
    rows = F.when(snap, F.concat(F.coalesce("bids", none), F.coalesce("asks", none))).otherwise(
        F.coalesce("changes", none)
    )
    first = F.when(snap, F.lit(0)).otherwise(F.lit(1))

    def unread(row: Column) -> Column:
        numbers = [F.get(row, first + k).try_cast("double") for k in (0, 1)]
        return numbers[0].isNull() | numbers[1].isNull()

    return (
        book.withColumn("n", F.size(F.filter(rows, unread)))
        .where("n > 0")
        .select(
            "arrival_seq",
            "raw",
            F.concat(F.lit(UNREADABLE), "type", F.lit(": "), F.col("n").cast("string")).alias("error"),
            "ingest_ts",
        )
    )


def counters(routed: DataFrame) -> DataFrame:
    """Messages per route."""
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("n"))
