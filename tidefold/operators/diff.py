"""What a publish has to do: current inventory against the previous manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefold.functions.names import current_key, key_prefix, versioned_key
from tidefold.schemas import MANIFEST_ENTRY_COLUMNS

ADDED, CHANGED, UNCHANGED, DELETED = "new", "changed", "unchanged", "deleted"


def manifest_diff(inventory: DataFrame, previous: DataFrame) -> DataFrame:
    """One row per path on either side, with `status` and both sides' hash and size.

    A table changed if its hash or its size differs.
    """
    now = inventory.select("relative_path", "sha256", "bytes")
    before = previous.select(
        "relative_path",
        F.col("sha256").alias("previous_sha256"),
        F.col("bytes").alias("previous_bytes"),
        *[c for c in ("current_key", "versioned_key") if c in previous.columns],
    )
    same = (F.col("sha256") == F.col("previous_sha256")) & (F.col("bytes") == F.col("previous_bytes"))
    status = (
        F.when(F.col("previous_sha256").isNull(), ADDED)
        .when(F.col("sha256").isNull(), DELETED)
        .when(same, UNCHANGED)
        .otherwise(CHANGED)
    )
    return now.join(before, "relative_path", "full").withColumn("status", status)


def is_upload() -> Column:
    return F.col("status").isin(ADDED, CHANGED)


def next_manifest_entries(diff: DataFrame, prefix: str, publish_id: str) -> DataFrame:
    """Entries of the next manifest.

    Uploaded tables get keys of this publish; unchanged ones keep their previous entry with
    the version they were published under; deleted ones drop out.
    """
    clean = key_prefix(F.lit(prefix))
    entries = diff.where(F.col("status") != DELETED).select(
        "relative_path",
        F.when(is_upload(), current_key(clean, F.col("relative_path")))
        .otherwise(F.col("current_key"))
        .alias("current_key"),
        F.when(is_upload(), versioned_key(clean, F.lit(publish_id), F.col("relative_path")))
        .otherwise(F.col("versioned_key"))
        .alias("versioned_key"),
        "sha256",
        "bytes",
    )
    return entries.select(*MANIFEST_ENTRY_COLUMNS)


def publish_summary(diff: DataFrame) -> DataFrame:
    """One row: tables in total, uploaded, deleted, unchanged, and whether to publish at all."""
    deleted = F.col("status") == DELETED
    counts = diff.agg(
        F.count_if(~deleted).alias("tables_total"),
        F.count_if(is_upload()).alias("tables_uploaded"),
        F.count_if(deleted).alias("tables_deleted"),
        F.count_if(F.col("status") == UNCHANGED).alias("tables_unchanged"),
    )
    return counts.withColumn("needs_publish", (F.col("tables_uploaded") + F.col("tables_deleted")) > 0)
