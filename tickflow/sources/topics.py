"""Topics as DataFrames: Kafka where its connector is present, else files.

Every reader yields the raw message shape: value, arrival_seq, conn_epoch,
ingest_ts. The arrival number of a Kafka record is its offset: a product is
keyed to one partition, so offsets order its messages.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow import schemas

EARLIEST = "earliest"


@dataclass(frozen=True)
class KafkaTopic:
    """A Kafka topic; ``per_trigger`` bounds the messages of one batch, a replay's too."""

    servers: str
    topic: str
    per_trigger: int | None = 1_000_000
    options: dict[str, str] = field(default_factory=dict)

    def _options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": EARLIEST,
            **self.options,
        }

    def read(self, spark: SparkSession) -> DataFrame:
        """Everything from the start to the current end."""
        reader = spark.read.format("kafka").options(**self._options())
        return records(reader.option("endingOffsets", "latest").load())

    def stream(self, spark: SparkSession) -> DataFrame:
        """Replay from the start: books can only begin at a snapshot."""
        reader = spark.readStream.format("kafka").options(**self._options())
        if self.per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(self.per_trigger))
        return records(reader.load())


def records(kafka: DataFrame) -> DataFrame:
    """Kafka records in the raw message shape; the envelope rides in the value."""
    text = F.col("value").cast("string")
    return kafka.select(
        text.alias("value"),
        F.col("offset").alias("arrival_seq"),
        F.expr("try_cast(get_json_object(CAST(value AS STRING), '$.conn_epoch') AS BIGINT)").alias(
            "conn_epoch"
        ),
        F.coalesce(
            F.get_json_object(text, "$.ingest_ts"),
            F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        ).alias("ingest_ts"),
    )


@dataclass(frozen=True)
class FileTopic:
    """A folder of parquet files in the raw message shape.

    Streams take files in order of modification time, so arrival order across
    batches is the order in which files were written.
    """

    path: str
    files_per_trigger: int | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(schemas.RAW_MESSAGE).parquet(self.path)

    def stream(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.schema(schemas.RAW_MESSAGE)
        if self.files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(self.files_per_trigger))
        return reader.parquet(self.path)


def json_bars(topic_rows: DataFrame, schema) -> DataFrame:
    """Bars from a JSON topic; malformed records are skipped."""
    bar = F.from_json("value", schema, {"mode": "PERMISSIVE"})
    return (
        topic_rows.withColumn("bar", bar)
        .where("bar.product_id IS NOT NULL AND bar.bar_ts IS NOT NULL")
        .select("bar.*", "arrival_seq")
    )
