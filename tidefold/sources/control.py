"""Checkpoint history: an append-only table, one row per checkpoint write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.schemas import CHECKPOINT_FILE_SCHEMA, DELTA_TAIL, INITIAL_SNAPSHOT
from tidefold.session import path_exists


def checked_phase(phase: Column | str = "phase") -> Column:
    phase = F.col(phase) if isinstance(phase, str) else phase
    bad = F.raise_error(F.concat(F.lit("unknown checkpoint phase "), F.coalesce(phase, F.lit("NULL")))).cast("string")
    return F.when(phase.isin(INITIAL_SNAPSHOT, DELTA_TAIL), phase).otherwise(bad)


def append_checkpoints(
    checkpoints: DataFrame, path: str, source_id: str, run_id: str, schema_hash: str | None = None
) -> None:
    """Append checkpoint rows in one job, stamped with the current time.

    `checkpoints` holds phase, snapshot_ts, snapshot_cursor, delta_cursor and `write_seq`,
    the order of the pages; data must be written before this is called.
    """
    rows = checkpoints.select(
        F.lit(source_id).alias("source_id"),
        checked_phase().alias("phase"),
        "snapshot_ts",
        "snapshot_cursor",
        "delta_cursor",
        F.lit(schema_hash).cast("string").alias("schema_hash"),
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("updated_at"),
        "write_seq",
    )
    rows.write.mode("append").parquet(path)


def read_history(spark: SparkSession, path: str, source_id: str | None = None) -> DataFrame:
    """The history, for one source if given; empty before the first write."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], CHECKPOINT_FILE_SCHEMA)
    history = spark.read.schema(CHECKPOINT_FILE_SCHEMA).parquet(path)
    return history if source_id is None else history.where(F.col("source_id") == source_id)
