"""Session set-up and the shared folder for hand-over tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

# AQE re-plans joins from real shuffle sizes: small sides become broadcast joins, partitions of a
# hot key are split across tasks, also where that costs one more exchange above the join.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Spark takes a file's bytes for the size of its rows; hash tables of them were 16 times as large.
    "spark.sql.sources.fileCompressionFactor": "16.0",
}
# Largest broadcast as a part of the driver's heap: a hash table takes about four times the bytes of its
# rows, and a dozen may be built at once.
BROADCASTS_IN_HEAP = 256


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings this package relies on to an existing session, for good: AQE, sizes
    of broadcasts that the driver can hold, and UTC as time zone, in which timestamps without a zone are read."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    heap = spark._jvm.java.lang.Runtime.getRuntime().maxMemory()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(min(broadcast_bytes(spark), heap // BROADCASTS_IN_HEAP)))
    if not spark.sparkContext.master.startswith("local"):
        # Start shuffles with a few partitions per core; AQE merges those that turn out small.
        wanted = 3 * spark.sparkContext.defaultParallelism
        given = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(given, wanted)))
    return spark


def broadcast_bytes(spark: SparkSession) -> int:
    """The session's limit for broadcasts; negative if there are none."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def release_garbage(spark: SparkSession) -> None:
    """Collects the driver's garbage if it fills half of the heap. Spark frees the broadcasts and shuffle files
    of finished steps only then, and a heap left to itself fills first."""
    runtime = spark._jvm.java.lang.Runtime.getRuntime()
    if runtime.totalMemory() - runtime.freeMemory() > runtime.maxMemory() // 2:
        spark._jvm.java.lang.System.gc()


def build_session(master: str = "local[8]", app: str = "shoplens", **conf: str) -> SparkSession:
    """Local session for tests and benchmarks; on a cluster use the session that is given."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
    )
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it gets a fresh temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir()


class HandOver:
    """Parquet hand-over between steps of a long job.

    A written table cuts the lineage, survives lost executors, and carries its exact size, so that
    later joins broadcast it only if it really is small. As a context manager it removes its tables
    at the end; without, they stay until :meth:`close`, as results read from them are lazy.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        self.spark = spark
        self.folder = os.path.join(folder or shared_folder(spark), f"tables-{uuid.uuid4().hex}")

    def __enter__(self) -> HandOver:
        return self

    def __exit__(self, *error) -> None:
        self.close()

    def close(self) -> None:
        """Remove all tables, through the file system that holds them."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def put(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write ``df`` once and return the table read back."""
        release_garbage(self.spark)
        df.write.mode("error").partitionBy(*partition_by).parquet(self.path(name))
        release_garbage(self.spark)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def put_many(self, builders: dict[str, Callable[[], DataFrame]], at_once: int = 6) -> dict[str, DataFrame]:
        """Write independent tables, a few jobs at a time, so that the tail of one job overlaps the
        next. If one fails, the others are cancelled."""
        context, tag = self.spark.sparkContext, f"hand-over-{uuid.uuid4().hex}"

        def write(name: str, build: Callable[[], DataFrame]) -> DataFrame:
            context.addJobTag(tag)
            try:
                return self.put(name, build())
            finally:
                context.removeJobTag(tag)

        with ThreadPoolExecutor(max_workers=at_once) as pool:
            written = {name: pool.submit(write, name, build) for name, build in builders.items()}
            try:
                return {name: job.result() for name, job in written.items()}
            except BaseException:
                for job in written.values():
                    job.cancel()
                context.cancelJobsWithTag(tag)
                raise
