"""Keyed JSON records for topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.spec import FeedSpec

DEAD_LETTERS = "dlq"


def keyed(df: DataFrame, topic: str | Column, key: str = "product_id") -> DataFrame:
    """(topic, key, value): the whole row as JSON, keyed so a product keeps its order."""
    name = F.lit(topic) if isinstance(topic, str) else topic
    return df.select(
        name.alias("topic"),
        F.col(key).alias("key"),
        F.to_json(F.struct(*df.columns)).alias("value"),
    )


def limited(records: DataFrame, spec: FeedSpec = FeedSpec()) -> DataFrame:
    """Records over the size limit go to the dead letters as a truncated copy."""
    size = F.octet_length("value")
    head = F.decode(F.substring(F.encode("value", "UTF-8"), 1, spec.truncated_bytes), "UTF-8")
    note = F.concat(
        F.lit("message too large ("), size.cast("string"), F.lit(" bytes) for "), "topic"
    )
    copy = F.to_json(
        F.struct(note.alias("error"), F.concat(head, F.lit("...")).alias("raw"))
    )
    big = (size > spec.max_message_bytes) & (F.col("topic") != DEAD_LETTERS)
    return records.select(
        F.when(big, F.lit(DEAD_LETTERS)).otherwise(F.col("topic")).alias("topic"),
        "key",
        F.when(big, copy).otherwise(F.col("value")).alias("value"),
    )


def write_kafka(records: DataFrame, servers: str, **options: str) -> None:
    """Send a batch of records, each to the topic it names."""
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).options(
        **options
    ).save()


def write_files(records: DataFrame, path: str, batch_id: int) -> None:
    """The same records as JSON lines, one folder per batch and topic."""
    records.write.mode("overwrite").partitionBy("topic").json(
        f"{path.rstrip('/')}/batch_id={batch_id}"
    )
