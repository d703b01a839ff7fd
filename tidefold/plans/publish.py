"""Publish changed staging tables and the manifest that describes them."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidefold.functions.names import view_name
from tidefold.operators.diff import DELETED, is_upload, manifest_diff, next_manifest_entries, publish_summary
from tidefold.operators.select import longest_prefix, require_covered, with_ordinal
from tidefold.plans.staging import read_table
from tidefold.schemas import MANIFEST_ENTRY_COLUMNS
from tidefold.session import remove_path, run_jobs
from tidefold.sources.manifest import latest_manifest, write_manifest
from tidefold.sources.views import quoted, register_views


@dataclass
class PublishSummary:
    publish_id: str
    tables_total: int
    tables_uploaded: int
    tables_deleted: int
    tables_unchanged: int


def clean_prefix(prefix: str | None) -> str:
    return (prefix or "").strip().strip("/")


def _location(bucket: str, prefix: str, *parts: str) -> str:
    return "/".join([bucket.rstrip("/"), *[part for part in (clean_prefix(prefix), *parts) if part]])


def manifests_path(bucket: str, prefix: str) -> str:
    return _location(bucket, prefix, "staging", "manifests")


def publish_diff(spark: SparkSession, inventory: DataFrame, bucket: str, prefix: str) -> DataFrame:
    return manifest_diff(inventory, latest_manifest(spark, manifests_path(bucket, prefix)))


def needs_publish(spark: SparkSession, inventory: DataFrame, bucket: str, prefix: str = "") -> bool:
    """Whether any table was added, changed or removed since the latest manifest."""
    return publish_summary(publish_diff(spark, inventory, bucket, prefix)).first()["needs_publish"]


def publish(
    spark: SparkSession,
    inventory: DataFrame,
    bucket: str,
    prefix: str = "",
    publish_id: str | None = None,
    threads: int = 8,
    mirror: bool = True,
) -> PublishSummary:
    """Copy changed tables, then point to them, then remove what is gone.

    `inventory` has relative_path, sha256, bytes, uris and schema, one row per table. The order is
    versioned copies, the manifest, the latest manifest, current copies, deletions. Versioned
    copies are never overwritten, and readers of the latest manifest and the views use them
    alone: whatever point a failure hits, they see the old state or the new one, whole. The
    `current` folder mirrors the newest versions for readers that know a path only; with
    `mirror=False` it is left out. A manifest is written even when no table changed.
    """
    published_ms = int(time.time() * 1000) if publish_id is None or not publish_id.isdigit() else int(publish_id)
    publish_id = publish_id or str(published_ms)
    diff = publish_diff(spark, inventory, bucket, prefix).persist()
    try:
        entries = next_manifest_entries(diff, prefix, publish_id)
        uploads = (
            diff.where(is_upload())
            .select("relative_path")
            .join(inventory.select("relative_path", "uris", "schema"), "relative_path")
            .join(entries.select("relative_path", "versioned_key", F.col("current_key").alias("key")), "relative_path")
            .collect()
        )
        stale = [row["current_key"] for row in diff.where(F.col("status") == DELETED).select("current_key").collect()]
        summary = publish_summary(diff).first()

        run_jobs(spark, [_copy(spark, row, _location(bucket, "", row["versioned_key"])) for row in uploads], threads)
        manifests = manifests_path(bucket, prefix)
        stored = f"{manifests}/{publish_id}.json"
        write_manifest(entries.coalesce(1), stored, publish_id, published_ms, bucket, clean_prefix(prefix))
        written = spark.read.schema(entries.schema).json(stored)
        write_manifest(written.coalesce(1), f"{manifests}/latest.json", publish_id, published_ms, bucket, clean_prefix(prefix))
        if mirror:
            copies = [(_location(bucket, "", row["versioned_key"]), _location(bucket, "", row["key"])) for row in uploads]
            run_jobs(spark, [_copy(spark, version, current) for version, current in copies], threads)
        for key in stale:
            remove_path(spark, _location(bucket, "", key))
    finally:
        diff.unpersist()
    return PublishSummary(
        publish_id=publish_id,
        tables_total=summary["tables_total"],
        tables_uploaded=summary["tables_uploaded"],
        tables_deleted=summary["tables_deleted"],
        tables_unchanged=summary["tables_unchanged"],
    )


def _copy(spark: SparkSession, origin: Row | str, target: str):
    """A job that copies a staged table, or the version at a path."""
    def copy() -> None:
        rows = spark.read.parquet(origin) if isinstance(origin, str) else read_table(spark, origin)
        rows.write.mode("overwrite").parquet(target)

    return copy


def source_map(manifest: DataFrame) -> DataFrame:
    """Published tables with their keys and position; typed and empty for an empty manifest."""
    return with_ordinal(manifest.select(*MANIFEST_ENTRY_COLUMNS))


def register_published_views(
    spark: SparkSession,
    bucket: str,
    prefix: str = "",
    database: str | None = None,
    locations: DataFrame | None = None,
    registry: str | None = None,
) -> list[str]:
    """One view per published table over its versioned copy, and `__source_map` over the manifest itself.

    In a database the views are persistent, and so is `__source_map`: it is a table there,
    because a manifest is replaced while views are read. `locations(url)` are the storage
    locations that may be read; a bucket that none of them covers is an error. `registry` is a
    folder in which the registrations are recorded, for `list_tables`.
    """
    if locations is not None:
        roots = spark.createDataFrame([(_location(bucket, prefix),)], "root string")
        require_covered(longest_prefix(roots, locations)).collect()
    manifest = latest_manifest(spark, manifests_path(bucket, prefix))
    named = manifest.select(view_name("relative_path").alias("view"), "versioned_key").orderBy("view").collect()
    names = register_views(
        spark, [(row["view"], _location(bucket, "", row["versioned_key"])) for row in named], database, registry
    )
    if database is None:
        source_map(manifest).createOrReplaceTempView("__source_map")
    else:
        source_map(manifest).coalesce(1).write.mode("overwrite").saveAsTable(f"{quoted(database)}.__source_map")
    return names
