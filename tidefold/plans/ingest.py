"""From landed pages to the change log or the bronze layer, with checkpoints.

Landing folder: `snapshot/` and `deltas/` hold page files, `schemas.json` the table schemas.
Phases go snapshot first, then deltas; the last snapshot page hands over to the delta tail.
All pages that are due in a phase form one load, written by one job. Data is written first
and its checkpoints after; a load's name follows from the checkpoint it starts at, so a run
that died in between is repeated under the same name and replaces what it had written.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidefold.functions.events import FAIL, QUARANTINE, normalise, quarantined, with_fingerprint
from tidefold.operators.checkpoints import resume_checkpoint
from tidefold.plans.staging import schema_catalog_path
from tidefold.schemas import CATALOG_SCHEMA, DELTA_TAIL, INITIAL_SNAPSHOT
from tidefold.session import broadcast_if_bounded, path_exists
from tidefold.sources.bronze import append_bronze
from tidefold.sources.catalog import catalog_hash, read_catalog, read_schema_file, write_catalog
from tidefold.sources.changelog import write_load
from tidefold.sources.control import append_checkpoints, read_history
from tidefold.sources.landing import due_headers, index_path, read_due, read_index, refresh_index
from tidefold.sources.pages import DELTA, PAGE_ORDER, SNAPSHOT, documents, with_checkpoint

@dataclass(frozen=True)
class Sink:
    """Where events go: `write` takes normalised events and a load's name, and returns their number."""

    write: Callable[[DataFrame, str], int]
    wants_creation_time: bool = False


_FOLDERS = {SNAPSHOT: "snapshot", DELTA: "deltas"}


@dataclass
class SyncSummary:
    snapshot_pages_fetched: int = 0
    delta_pages_fetched: int = 0
    events_written: int = 0
    final_checkpoint: Row | None = None


def load_name(kind: str, *parts: object) -> str:
    """Name of a load: different for every source and start, the same when a run is repeated."""
    return f"{kind}-{hashlib.sha256(json.dumps(parts, default=str).encode()).hexdigest()}"


def log_sink(log: str) -> Sink:
    """Write events to the change log."""

    def write(events: DataFrame, load_id: str) -> int:
        spark = events.sparkSession
        if not write_load(events, log, load_id):
            return 0
        return spark.read.parquet(f"{log}/load_id={load_id}").count()

    return Sink(write)


def bronze_sink(root: str, source_id: str, run_id: str) -> Sink:
    """Write events to the bronze layer, routed by table."""

    def write(events: DataFrame, load_id: str) -> int:
        routed = append_bronze(events, root, load_id, source_id, run_id)
        return routed.agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0]

    return Sink(write, wants_creation_time=True)


def save_catalog(spark: SparkSession, landing: str, log: str) -> DataFrame:
    """Persist the landed schemas next to the log and return the catalog; empty without schemas."""
    landed = f"{landing}/schemas.json"
    if path_exists(spark, landed):
        found = read_schema_file(spark, landed)
        # Readers of an unchanged catalog are not disturbed.
        if catalog_hash(found) != catalog_hash(read_catalog(spark, schema_catalog_path(log))):
            write_catalog(found, schema_catalog_path(log))
    catalog = read_catalog(spark, schema_catalog_path(log))
    return spark.createDataFrame([], CATALOG_SCHEMA) if catalog is None else catalog


def sync_once(
    spark: SparkSession,
    landing: str,
    sink: Sink,
    catalog: DataFrame,
    control: str,
    source_id: str,
    run_id: str,
    table: str | None = None,
    schema_hash: str | None = None,
    max_pages: int | None = None,
    on_error: str = FAIL,
    quarantine: str | None = None,
) -> SyncSummary:
    """Bring everything that has landed into the sink and advance the checkpoint.

    Deltas are read only once the snapshot is complete, and then to the last page that has
    landed, however many polls the backlog holds. What is due is found in an index of the landed
    pages, so a run opens the files that are new and no others. With `on_error="quarantine"` bad documents
    are kept below the folder `quarantine`, which is required.
    """
    if on_error == QUARANTINE and quarantine is None:
        raise ValueError("quarantine mode needs a folder for the documents it leaves out")
    catalog = broadcast_if_bounded(catalog.select("table_name", "fingerprint"))
    summary = SyncSummary()

    def run_phase(kind: str, after: object, start: str) -> int:
        folder = f"{landing}/{_FOLDERS[kind]}"
        if not path_exists(spark, folder):
            return 0
        order = PAGE_ORDER[kind]
        index = index_path(control, folder, kind)
        found = due_headers(spark, folder, kind, index, after, max_pages, past_ends=kind == DELTA)
        headers = with_checkpoint(found.withColumn("filled", F.col("events") > 0), kind).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            bounds = headers.agg(
                F.count("*").alias("n"),
                # An idle poll repeats the cursor of the one before and brings nothing.
                F.count_if("filled").alias("filled"),
                F.count_distinct(F.when(F.col("filled"), F.col(order))).alias("distinct"),
            ).first()
            if not bounds["n"]:
                return 0
            if bounds["distinct"] != bounds["filled"]:
                raise ValueError(f"{kind} pages are not told apart by {order}")
            due = with_checkpoint(read_due(spark, folder, kind, headers), kind)
            values = documents(due, table)
            events = normalise(values, on_error=on_error, creation_time=sink.wants_creation_time)
            load_id = load_name(kind, source_id, start)
            summary.events_written += sink.write(with_fingerprint(events, catalog), load_id)
            if on_error == QUARANTINE:
                bad = quarantined(values)
                bad.write.mode("overwrite").parquet(f"{quarantine}/load_id={load_id}")
            steps = headers.orderBy(order).withColumn("write_seq", F.monotonically_increasing_id())
            append_checkpoints(steps, control, source_id, run_id, schema_hash)
            return bounds["n"]
        finally:
            headers.unpersist()

    def checkpoint() -> Row | None:
        return resume_checkpoint(read_history(spark, control), source_id).first()

    at = checkpoint()
    if at is None or at["phase"] == INITIAL_SNAPSHOT:
        after = None if at is None else _snapshot_position(spark, f"{landing}/{_FOLDERS[SNAPSHOT]}", control, at)
        start = "start" if at is None else f"{at['snapshot_ts']}|{at['snapshot_cursor']}"
        summary.snapshot_pages_fetched = run_phase(SNAPSHOT, after, start)
        at = checkpoint()
    if at is not None and at["phase"] == DELTA_TAIL:
        if at["delta_cursor"] is None:
            raise ValueError("checkpoint has no delta cursor to go on from")
        summary.delta_pages_fetched = run_phase(DELTA, at["delta_cursor"], f"after-{at['delta_cursor']}")
        at = checkpoint()
    summary.final_checkpoint = at
    return summary


def _snapshot_position(spark: SparkSession, folder: str, control: str, at: Row) -> str:
    """Place of the page that led to a snapshot checkpoint."""
    index = index_path(control, folder, SNAPSHOT)
    refresh_index(spark, folder, SNAPSHOT, index)
    same = (F.col("snapshot") == at["snapshot_ts"]) & (F.col("cursor") == at["snapshot_cursor"])
    page = read_index(spark, index, SNAPSHOT).where(same & F.col("has_more")).agg(F.max("place").alias("place")).first()
    if page["place"] is None:
        raise ValueError(f"no landed page has the snapshot cursor {at['snapshot_cursor']!r}")
    return page["place"]
