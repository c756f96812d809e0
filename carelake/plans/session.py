"""Session settings and the shared folder for intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a dominant key even where the next operator could have used the join's partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("carelake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        # Small local files in several splits, so that all cores read.
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.sql.files.openCostInBytes", "1m")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a scratch folder only in local mode."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folders.setdefault(context.applicationId, tempfile.mkdtemp(prefix="carelake-"))


def scratch_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_folder(spark)}/carelake/{spark.sparkContext.applicationId}"


def written(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """``df`` stored as Parquet in the shared folder and read back.

    This cuts the lineage where one result feeds several reads: the work behind it runs
    once, later reads prune columns, and a lost executor costs nothing that was written.
    The exact size is known afterwards, so a small result is broadcast by Spark's own check.
    """
    return written_at(df, label, codec)[0]


def written_at(df: DataFrame, label: str, codec: str | None = None) -> tuple[DataFrame, str]:
    """``written`` with the folder, for one that is discarded before the application ends."""
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder; what was read from it ends with it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files in a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def discard_written(spark: SparkSession) -> None:
    """Delete what ``written`` stored for this application; its DataFrames end with it."""
    discard(spark, scratch_folder(spark))


BATCH_ROWS, BATCH_BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 512, size: str = "4m") -> Iterator[None]:
    """Jobs started inside hand their rows to Python in batches of at most ``rows`` rows and little more than ``size``.

    A task otherwise holds up to 10,000 whole texts at once, as Arrow buffers in the executor and again in its Python worker.
    """
    before = {key: spark.conf.get(key, None) for key in (BATCH_ROWS, BATCH_BYTES)}
    spark.conf.set(BATCH_ROWS, str(rows))
    spark.conf.set(BATCH_BYTES, size)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of queries that nothing refers to any more.

    It learns of them when the driver's memory is collected, which a large driver does seldom.
    """
    spark._jvm.java.lang.System.gc()
