"""The append-only change log.

Layout: `load_id=<id>/component_key=<c>/table_key=<t>/part-*.parquet`. A load is the unit of
idempotence: writing it again replaces it as a whole, so replays never duplicate. One load may
hold one page or many; rows keep the page's batch name and their position in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.functions.names import directory_key
from tidefold.schemas import (
    DELETE,
    LOG_FILE_SCHEMA,
    LOG_SCHEMA,
    RAW_LOG_COLUMNS,
    RAW_LOG_SCHEMA,
    UPSERT,
)
from tidefold.session import committed_marks, list_names, partition_values, remove_path

LOG_KEYS = ["component_key", "table_key"]


def checked_op(op: Column | str = "op") -> Column:
    """The operation, or an error for anything but an upsert or a delete."""
    op = F.col(op) if isinstance(op, str) else op
    bad = F.raise_error(F.concat(F.lit("unexpected op value "), F.coalesce(op, F.lit("NULL")))).cast("string")
    return F.when(op.isin(UPSERT, DELETE), op).otherwise(bad)


def read_change_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Seven-column log files from anywhere: a directory's own *.parquet, or listed files.

    The file name is the batch and the row index the position, which gives read order its
    usual meaning: files by name, rows as stored.
    """
    files = spark.read.schema(RAW_LOG_SCHEMA).option("pathGlobFilter", "*.parquet").parquet(*paths)
    return files.select(
        *[checked_op().alias("op") if name == "op" else name for name in RAW_LOG_COLUMNS],
        F.col("_metadata.file_name").alias("batch"),
        F.col("_metadata.row_index").alias("position"),
    )


def write_load(events: DataFrame, log: str, load_id: str) -> bool:
    """Write or replace one load. An empty load leaves nothing behind; returns whether rows were written.

    Rebalancing by table lets adaptive execution split big tables over several files and put
    small ones into one.
    """
    spark = events.sparkSession
    target = f"{log}/load_id={load_id}"
    rows = events.select(
        *[checked_op().alias("op") if name == "op" else name for name in LOG_FILE_SCHEMA.fieldNames()],
        directory_key("component_path").alias("component_key"),
        directory_key("table_name").alias("table_key"),
    )
    rows.hint("rebalance", *LOG_KEYS).write.mode("overwrite").partitionBy(*LOG_KEYS).parquet(target)
    if not any(name.startswith("component_key=") for name in list_names(spark, target)):
        remove_path(spark, target)
        return False
    return True


def load_marks(spark: SparkSession, log: str) -> dict[str, int]:
    """Complete loads of the log, each with a mark that changes when the load is replaced."""
    return committed_marks(spark, log, "load_id")


def load_ids(spark: SparkSession, log: str) -> list[str]:
    """Complete loads of the log, in name order."""
    return partition_values(spark, log, "load_id")


def read_log(spark: SparkSession, log: str, loads: Sequence[str] | None = None) -> DataFrame:
    """Stored log rows; `loads` restricts the read to some loads without listing the others."""
    reader = spark.read.schema(LOG_SCHEMA).option("basePath", log)
    if loads is None:
        loads = load_ids(spark, log)
    if not loads:
        return spark.createDataFrame([], LOG_SCHEMA)
    return reader.parquet(*[f"{log}/load_id={load}" for load in loads])


def stream_log(spark: SparkSession, log: str, max_files: int = 1000) -> DataFrame:
    """The log as a stream of newly written files."""
    return spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(log)


def public_columns(log: DataFrame) -> DataFrame:
    return log.select(*RAW_LOG_COLUMNS)
