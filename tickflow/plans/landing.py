"""Feed landing: parse every raw message once, write typed tables per route."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.operators import gaps, quality, router
from tickflow.session import materialize
from tickflow.spec import FeedSpec


@dataclass(frozen=True)
class Landed:
    """Typed rows of one stretch of feed."""

    trades: DataFrame
    books: DataFrame
    heartbeats: DataFrame
    dead: DataFrame


def land(raw: DataFrame, spec: FeedSpec = FeedSpec()) -> Landed:
    """Route raw messages; JSON is parsed in a single pass over the input.

    The routed rows are written as one table partitioned by route, so each
    consumer reads only its own files and columns.
    """
    routed = router.route(raw)
    big = F.col("route").isin("trades", "book") & (
        F.octet_length("value") > spec.max_message_bytes
    )
    kept = routed.select(
        *[c for c in raw.columns if c != "value"],
        F.when(F.col("route") == "dlq", F.col("value")).alias("value"),
        F.when(~big, F.col("msg")).alias("msg"),
        F.when(big, router.oversize_letter(spec)).alias("letter"),
        "error",
        "route",
        big.alias("oversize"),
    )
    table = materialize(kept, "landed", partition_by="route")
    fits = table.where("NOT oversize")
    return Landed(
        trades=router.trades(fits),
        books=router.book_messages(fits),
        heartbeats=router.heartbeats(table),
        dead=router.dead_letters(table).unionByName(
            table.where("oversize").select("arrival_seq", "ingest_ts", "letter.*")
        ),
    )


def gate(landed: Landed, spec: FeedSpec = FeedSpec()) -> bool:
    """The acceptance check of a capture: no gap, no dead letter, some trades."""
    return bool(quality.feed_gate(landed.trades, landed.dead, spec).first().passed)


def epochs(raw: DataFrame, spec: FeedSpec = FeedSpec()) -> DataFrame:
    """A captured log with its connection epochs numbered anew."""
    return gaps.connection_epochs(router.route(raw.drop("conn_epoch")), spec).select(
        "value", "arrival_seq", "ingest_ts", F.col("epoch").alias("conn_epoch")
    )
