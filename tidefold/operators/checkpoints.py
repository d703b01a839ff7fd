"""Queries over the checkpoint history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.operators.fold import latest_by
from tidefold.schemas import CHECKPOINT_COLUMNS


def _latest_order(history: DataFrame) -> list[str]:
    order = ["updated_at", "run_id"]
    return [*order, "write_seq"] if "write_seq" in history.columns else order


def latest_checkpoints(history: DataFrame) -> DataFrame:
    """Newest checkpoint of every source; `run_id` is compared as text."""
    return latest_by(history, ["source_id"], _latest_order(history)).select(*CHECKPOINT_COLUMNS)


def resume_checkpoint(history: DataFrame, source_id: str) -> DataFrame:
    """Zero or one row: where this source goes on."""
    newest_first = [F.col(name).desc() for name in _latest_order(history)]
    return (
        history.where(F.col("source_id") == source_id)
        .orderBy(*newest_first)
        .limit(1)
        .select(*CHECKPOINT_COLUMNS)
    )


def recent_checkpoints(history: DataFrame, limit: int = 50) -> DataFrame:
    """The latest writes over all sources."""
    order = [F.col("updated_at").desc(), *[F.col(name).desc() for name in _latest_order(history)[1:]]]
    columns = ["source_id", "phase", "snapshot_ts", "delta_cursor", "run_id", "updated_at"]
    return history.orderBy(*order).limit(limit).select(*columns)


def smoke_check(history: DataFrame, limit: int = 5) -> DataFrame:
    """Newest sources of the latest view."""
    latest = latest_checkpoints(history)
    return latest.orderBy(F.col("updated_at").desc(), "source_id").limit(limit).select("source_id", "phase", "updated_at")


def checkpoint_writes(history: DataFrame) -> DataFrame:
    return history.groupBy("source_id").agg(F.count("*").alias("checkpoint_write_count"))
