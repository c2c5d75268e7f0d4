"""Session helpers: UTC clock and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tickflow")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return use_utc(spark)


def use_utc(spark: SparkSession) -> SparkSession:
    """All clocks in the feed are UTC; a local zone would shift window edges."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by the cluster.

    Only a local session that names none (a test) gets a folder made for it; on a cluster
    each executor would write to a disk of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not named:
        named = tempfile.mkdtemp(prefix="tickflow-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Scratch:
    """Scratch tables of one piece of work, which go when it is done.

    Within ``with Scratch(spark) as scratch`` all tables that ``materialize`` writes are
    deleted at the end, but for those that ``scratch.keep`` writes. Nothing that is still
    to be read may depend on the others.
    """

    _open: list[Scratch] = []

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        Scratch._open.append(self)
        return self

    def __exit__(self, *error) -> None:
        Scratch._open.remove(self)
        for path in self.paths:
            target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """A written table that stays until the driver ends, or for the work around this."""
        path = _write(df, name, None)
        outer = Scratch._open[: Scratch._open.index(self)]
        if outer:
            outer[-1].paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)


def _write(df: DataFrame, name: str, partition_by: str | None) -> str:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    _delete_on_exit(spark, path)
    return path


def write_scratch(df: DataFrame, name: str, partition_by: str | None = None) -> str:
    """Write ``df`` as a scratch table in the shared folder; returns its path."""
    path = _write(df, name, partition_by)
    if Scratch._open:
        Scratch._open[-1].paths.append(path)
    return path


def materialize(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write once, read many: cuts lineage behind an expensive step.

    A columnar table in the shared folder survives lost executors and lets each
    reader prune columns and push filters, which a cache or checkpoint cannot.
    """
    path = write_scratch(df, name, partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    """Scratch tables go when the driver ends, on whatever file system they are."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
