"""One round of the recurring export: sync, maintain staging, publish what changed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from tidefold.plans.ingest import SyncSummary, log_sink, save_catalog, sync_once
from tidefold.plans.publish import PublishSummary, needs_publish, publish
from tidefold.plans.staging import StagingSummary, drop_old_versions, materialise, read_ledger, staging_inventory
from tidefold.sources.catalog import catalog_hash


@dataclass(frozen=True)
class ServicePaths:
    landing: str
    log: str
    control: str
    staging: str
    bucket: str
    prefix: str = ""


@dataclass
class RoundSummary:
    iteration: int
    sync: SyncSummary
    staging: StagingSummary
    publish: PublishSummary | None


def should_publish(staging: StagingSummary) -> bool:
    return staging.new_raw_files > 0 or staging.affected_tables > 0 or staging.tables_materialized > 0


def run_round(spark: SparkSession, paths: ServicePaths, source_id: str, run_id: str, iteration: int = 1) -> RoundSummary:
    """The catalog is stored before any event; publishing is skipped when the target is current.

    Versions of staging tables that nothing refers to any more are deleted at the end.
    """
    catalog = save_catalog(spark, paths.landing, paths.log)
    sync = sync_once(
        spark, paths.landing, log_sink(paths.log), catalog, paths.control, source_id, run_id,
        schema_hash=catalog_hash(catalog),
    )
    staging = materialise(spark, paths.log, paths.staging)
    published = None
    if read_ledger(spark, paths.staging) is not None:
        inventory = staging_inventory(spark, paths.staging)
        if should_publish(staging) or needs_publish(spark, inventory, paths.bucket, paths.prefix):
            published = publish(spark, inventory, paths.bucket, paths.prefix)
        drop_old_versions(spark, paths.staging)
    return RoundSummary(iteration, sync, staging, published)


def run_rounds(spark: SparkSession, paths: ServicePaths, source_id: str, run_id: str, max_iterations: int) -> list[RoundSummary]:
    """A fixed number of rounds. Repeating them on a clock is the job scheduler's work."""
    if max_iterations < 0:
        raise ValueError("max_iterations must not be negative")
    return [run_round(spark, paths, source_id, run_id, number) for number in range(1, max_iterations + 1)]
