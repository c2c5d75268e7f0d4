"""Day-partitioned parquet tables: append, idempotent batches, versions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Bytes of a file that compaction aims at.
TARGET_BYTES = 128 << 20


def with_day(df: DataFrame, ts_column: str, day_column: str) -> DataFrame:
    return df.withColumn(day_column, F.col(ts_column).cast("date"))


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Few, even files per partition value: small ones merge, hot ones split."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def write_partitioned(
    df: DataFrame, path: str, ts_column: str, day_column: str, mode: str = "append"
) -> None:
    """Write into day partitions."""
    dated = with_day(df, ts_column, day_column)
    balanced(dated, day_column).write.mode(mode).partitionBy(day_column).parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One micro-batch under its own folder: a retry replaces its first try."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("basePath", path).parquet(path)


@dataclass(frozen=True)
class BatchTable:
    """A day-partitioned table that a stream appends to batch by batch.

    Files lie by day, so readers prune days, and under their batch's number within: a
    batch that is tried again replaces what its first try left, and no other file.
    """

    root: str
    schema: T.StructType
    ts_column: str
    day_column: str

    def commit(self, df: DataFrame, batch_id: int) -> None:
        """Write a batch; all its days appear together when the write is done."""
        dated = with_day(df, self.ts_column, self.day_column)
        dated = dated.withColumn("batch_id", F.lit(batch_id).cast("long"))
        writer = balanced(dated, self.day_column).write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(self.day_column, "batch_id").parquet(self.root)

    def exists(self, spark: SparkSession) -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

    def _stored(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])
        if not self.exists(spark):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self.root)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._stored(spark).drop("batch_id")

    def batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What a batch wrote, without its day; other batches' files are not opened."""
        stored = self._stored(spark).where(F.col("batch_id") == batch_id)
        return stored.drop("batch_id", self.day_column)

    def reset(self, spark: SparkSession) -> None:
        """Start over; the stream's checkpoint has to go as well."""
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: What a version takes over from older ones: day folders, one path per line.
INHERITED = "_inherited"


@dataclass(frozen=True)
class VersionedTable:
    """Complete builds side by side; readers take the newest finished one.

    Rewrites (compaction, reset) never touch files that a reader may hold. A version may
    take over day folders of older ones; it then names them in a list of its own.
    """

    root: str
    schema: T.StructType
    ts_column: str
    day_column: str

    def _folder(self, version: int) -> str:
        return f"{self.root.rstrip('/')}/version={version}"

    def _fs(self, spark: SparkSession):
        jvm = spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _names(self, spark: SparkSession, folder: str) -> list[str]:
        fs, path = self._fs(spark)
        if not fs.exists(path(folder)):
            return []
        return [s.getPath().getName() for s in fs.listStatus(path(folder))]

    def versions(self, spark: SparkSession) -> list[int]:
        """Finished versions, oldest first."""
        fs, path = self._fs(spark)
        found = self._names(spark, self.root)
        numbers = sorted(int(n.split("=")[1]) for n in found if n.startswith("version="))
        return [n for n in numbers if fs.exists(path(f"{self._folder(n)}/_SUCCESS"))]

    def _inherited(self, spark: SparkSession, version: int) -> list[str]:
        """Day folders of older versions that belong to this one."""
        fs, path = self._fs(spark)
        listed = path(f"{self._folder(version)}/{INHERITED}")
        if not fs.exists(listed):
            return []
        stream = fs.open(listed)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [line for line in text.split("\n") if line]

    def _days(self, spark: SparkSession, version: int) -> list[str]:
        """Day folders of a version, below the root; a day may have one in each of two."""
        own = [n for n in self._names(spark, self._folder(version)) if n.startswith(f"{self.day_column}=")]
        return [*self._inherited(spark, version), *(f"version={version}/{n}" for n in own)]

    def _read(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        root = self.root.rstrip("/")
        paths = [f"{root}/{f}" for f in folders]
        schema = T.StructType([*self.schema.fields, T.StructField("version", T.LongType())])
        found = spark.read.schema(schema).option("basePath", root).parquet(*paths)
        return found.select(*self.schema.names)

    def read(self, spark: SparkSession) -> DataFrame:
        done = self.versions(spark)
        if not done:
            return spark.createDataFrame([], self.schema)
        taken = self._inherited(spark, done[-1])
        if taken:
            return self._read(spark, [*taken, f"version={done[-1]}"])
        return spark.read.schema(self.schema).parquet(self._folder(done[-1]))

    def publish(self, df: DataFrame) -> int:
        """Write a new complete version and return its number."""
        done = self.versions(df.sparkSession)
        number = done[-1] + 1 if done else 1
        write_partitioned(
            df, self._folder(number), self.ts_column, self.day_column, mode="overwrite"
        )
        return number

    def append(self, df: DataFrame) -> None:
        """Add rows to the newest version."""
        done = self.versions(df.sparkSession)
        if not done:
            self.publish(df)
            return
        write_partitioned(df, self._folder(done[-1]), self.ts_column, self.day_column)

    def fragmented(self, spark: SparkSession, target_bytes: int = TARGET_BYTES) -> dict[str, list[str]]:
        """Days of the newest version that have more files than their bytes need, with
        their folders."""
        fs, path = self._fs(spark)
        days: dict[str, list[str]] = {}
        files: dict[str, list[int]] = {}
        for folder in self._days(spark, self.versions(spark)[-1]):
            day = folder.rpartition("/")[2]
            days.setdefault(day, []).append(folder)
            listed = fs.listStatus(path(f"{self.root.rstrip('/')}/{folder}"))
            sizes = [s.getLen() for s in listed if not s.getPath().getName().startswith(("_", "."))]
            files.setdefault(day, []).extend(sizes)
        needed = {day: max(-(-sum(n) // target_bytes), 1) for day, n in files.items()}
        return {day: days[day] for day, n in files.items() if len(n) > needed[day]}

    def compact(self, spark: SparkSession, target_bytes: int = TARGET_BYTES) -> int:
        """Rewrite fragmented days alone, as a new version that takes over all others.

        The new version is written aside and appears by one rename, so a reader sees the
        old files or the new ones. Returns the newest version's number.
        """
        done = self.versions(spark)
        days = self.fragmented(spark, target_bytes) if done else {}
        if not days:
            return done[-1] if done else 0
        fs, path = self._fs(spark)
        number, root = done[-1] + 1, self.root.rstrip("/")
        aside = f"{root}/_version={number}"
        old = [f for folders in days.values() for f in folders]
        rows = self._read(spark, old).drop(self.day_column)
        write_partitioned(rows, aside, self.ts_column, self.day_column, mode="overwrite")
        kept = [f for f in self._days(spark, done[-1]) if f not in set(old)]
        out = fs.create(path(f"{aside}/{INHERITED}"), True)
        out.write("\n".join(kept).encode())
        out.close()
        if not fs.rename(path(aside), path(self._folder(number))):
            raise FileExistsError(self._folder(number))
        return number

    def reset(self, spark: SparkSession) -> int:
        """Start over with an empty version."""
        return self.publish(spark.createDataFrame([], self.schema))

    def retain(self, spark: SparkSession, keep: int) -> list[int]:
        """Drop all but the newest ``keep`` finished versions.

        Day folders that a kept version has taken over stay; the rest of a dropped
        version goes.
        """
        fs, path = self._fs(spark)
        done = self.versions(spark)
        old, kept = done[: -max(keep, 1)], done[-max(keep, 1) :]
        used = {f for n in kept for f in self._inherited(spark, n)}
        for number in old:
            names = self._names(spark, self._folder(number))
            held = [n for n in names if f"version={number}/{n}" in used]
            if not held:
                fs.delete(path(self._folder(number)), True)
                continue
            # Without its mark it is no version any more.
            for name in ["_SUCCESS", *(n for n in names if n not in held and n != "_SUCCESS")]:
                fs.delete(path(f"{self._folder(number)}/{name}"), True)
        return old
