"""Session helpers: scratch space, path listing, bounded broadcasts, shuffle files, job fan-out."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR_KEY = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# What may be broadcast: at most this many bytes of column values.
BROADCAST_BYTES = 64 * 1024 * 1024

# Scratch folders of local sessions that name no shared folder, by application.
_local_dirs: dict[str, str] = {}


def local_session(
    app_name: str = "tidefold", cpus: int | str = "*", partitions: int = 8, scratch: str | None = None
) -> SparkSession:
    """A session for tests and benches; a cluster job brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]")
    if scratch is not None:
        builder = builder.config(CHECKPOINT_DIR_KEY, scratch)
    return (
        builder
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local path would be lost with its machine, so a missing setting is an error.
    """
    configured = spark.conf.get(CHECKPOINT_DIR_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR_KEY} to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="tidefold-")
    return _local_dirs[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below `path`, sorted; empty when it does not exist."""
    filesystem, hadoop_path = _filesystem(spark, path)
    if not filesystem.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in filesystem.listStatus(hadoop_path))


def path_exists(spark: SparkSession, path: str) -> bool:
    filesystem, hadoop_path = _filesystem(spark, path)
    return filesystem.exists(hadoop_path)


def remove_path(spark: SparkSession, path: str) -> None:
    filesystem, hadoop_path = _filesystem(spark, path)
    filesystem.delete(hadoop_path, True)


def committed_marks(spark: SparkSession, path: str, column: str) -> dict[str, int]:
    """Committed values of one partition column, in order, each with the time of its commit.

    One call to the file system, however many values there are. A directory that is written
    again gets another mark.
    """
    found = _parents(spark, path, column, "_SUCCESS")
    return dict(sorted((name, status.getModificationTime()) for name, status in found))


def filled_partitions(spark: SparkSession, path: str, column: str, inner: str) -> set[str]:
    """Values of one partition column below which there are partitions of `inner`."""
    return {name for name, _ in _parents(spark, path, column, f"{inner}=*")}


def _parents(spark: SparkSession, path: str, column: str, inside: str) -> list[tuple[str, object]]:
    """(value, file status) for everything that matches `<path>/<column>=<value>/<inside>`."""
    filesystem, pattern = _filesystem(spark, f"{glob_escaped(path)}/{column}=*/{inside}")
    statuses = filesystem.globStatus(pattern) or []
    return [(status.getPath().getParent().getName()[len(column) + 1:], status) for status in statuses]


def glob_escaped(path: str) -> str:
    """The path as a pattern that matches it alone."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of one partition column whose directory was committed (`_SUCCESS` present), in order."""
    return list(committed_marks(spark, path, column))


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the values of `df` are small enough to be sent to every executor; measured, not estimated."""
    per_row = [F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0)) + 16 for name in df.columns]
    size = df.agg(F.sum(sum(per_row[1:], per_row[0]).cast("bigint")).alias("size")).first()["size"]
    return (size or 0) <= max_bytes


def broadcast_if_bounded(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast `df` only after measuring it.

    Beyond the bound the frame is returned as it is: Spark then plans a shuffled join and
    adaptive execution splits the skewed partitions of the other side.
    """
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def with_adaptive_execution(batch: DataFrame) -> DataFrame:
    """Turn adaptive execution on for what a micro-batch writes.

    Streaming sessions start with it off, for the sake of stateful operators; the streams
    here have none, and their writes need skewed tables to be split.
    """
    batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
    return batch


def query_id(spark: SparkSession) -> str:
    """Identifier of the streaming query whose micro-batch is being processed.

    It is stored in the query's checkpoint: a restart keeps it, a new checkpoint has another.
    """
    found = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise RuntimeError("no micro-batch is being processed here")
    return found


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What ends inside has its shuffle files removed then, not when the driver happens to collect its garbage.

    For runs of many writes from one thread; a frame that is executed again repeats its shuffles.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP_KEY, None)
    spark.conf.set(SHUFFLE_CLEANUP_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_KEY)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_KEY, before)


def run_jobs(spark: SparkSession, jobs: Iterable[Callable[[], object]], threads: int = 8) -> list[object]:
    """Submit independent Spark jobs from a few driver threads and wait for all of them."""
    with ThreadPoolExecutor(max_workers=threads) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [future.result() for future in futures]
