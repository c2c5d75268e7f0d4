"""Tables: partitioned files, and relational databases over JDBC."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow import schemas


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, day_column: str | None = None
) -> DataFrame:
    """A table of files with a declared schema; its day partition stays visible."""
    if day_column is None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.schema(schemas.with_day(schema, day_column)).parquet(path)


def since(df: DataFrame, ts_column: str, day_column: str, start: datetime) -> DataFrame:
    """Rows after ``start``, pruned by day partition and pushed to the scan."""
    at = F.lit(start).cast("timestamp_ntz")
    return df.where((F.col(day_column) >= at.cast("date")) & (F.col(ts_column) > at))


def read_relation(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 16,
    **options: str,
) -> DataFrame:
    """A relational table; with a partition column it is read by many tasks."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", str(partitions))
        )
    return reader.options(**options).load()
