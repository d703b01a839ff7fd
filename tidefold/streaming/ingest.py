"""Continuous ingest: landed pages as a stream into the change log or the bronze layer."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidefold.functions.events import FAIL, QUARANTINE, normalise, quarantined, with_fingerprint
from tidefold.functions.names import directory_key_text
from tidefold.operators.checkpoints import resume_checkpoint
from tidefold.plans.ingest import Sink, load_name
from tidefold.schemas import DELTA_TAIL
from tidefold.session import broadcast_if_bounded, partition_values, query_id, remove_path, with_adaptive_execution
from tidefold.sources.control import append_checkpoints, read_history
from tidefold.sources.pages import DELTA, PAGE_ORDER, documents, with_checkpoint

# The two queries of a source may reach the end of the snapshot at once.
_releasing = threading.Lock()


def start(
    pages: DataFrame,
    kind: str,
    sink: Sink,
    catalog: DataFrame,
    control: str,
    source_id: str,
    run_id: str,
    checkpoint: str,
    table: str | None = None,
    continuous_every: str | None = None,
    on_error: str = FAIL,
    quarantine: str | None = None,
    parked: str | None = None,
) -> StreamingQuery:
    """Each micro-batch is one load, named after source, query and batch: a repeated batch replaces itself.

    Two sources, or one source read again with a new checkpoint folder, never share a name.
    The data of a batch is written first, the checkpoints its pages lead to after; pages that
    land late, or come again, do not move the checkpoint back. A delta batch fails as long as
    the snapshot is incomplete, and is taken up again when the query is restarted; with a folder
    `parked`, given to both queries of a source, it is kept there instead. The batch that completes
    the snapshot, or the next delta batch after it, takes up what is parked, in order.
    """
    if on_error == QUARANTINE and quarantine is None:
        raise ValueError("quarantine mode needs a folder for the documents it leaves out")
    fingerprints = broadcast_if_bounded(catalog.select("table_name", "fingerprint"))

    def reached(spark: SparkSession) -> Row | None:
        return resume_checkpoint(read_history(spark, control), source_id).first()

    def write(pages: DataFrame, kind: str, load_id: str) -> None:
        """One load and its checkpoints."""
        at = reached(pages.sparkSession)
        in_tail = at is not None and at["phase"] == DELTA_TAIL
        known = with_checkpoint(pages, kind)
        values = documents(known, table)
        events = normalise(values, on_error=on_error, creation_time=sink.wants_creation_time)
        sink.write(with_fingerprint(events, fingerprints), load_id)
        if on_error == QUARANTINE:
            quarantined(values).write.mode("overwrite").parquet(f"{quarantine}/load_id={load_id}")
        steps = known.drop("values").orderBy(PAGE_ORDER[kind]).withColumn("write_seq", F.monotonically_increasing_id())
        if kind == DELTA:
            steps = steps.where(F.col("delta_cursor") > F.lit(at["delta_cursor"]))
        if kind == DELTA or not in_tail:
            append_checkpoints(steps, control, source_id, run_id)

    def release(spark: SparkSession) -> None:
        """Write what is parked, oldest first; each batch goes once it is written, under a name of its own."""
        with _releasing:
            for name in partition_values(spark, f"{parked}/{directory_key_text(source_id)}", "batch"):
                folder = f"{parked}/{directory_key_text(source_id)}/batch={name}"
                write(spark.read.parquet(folder), DELTA, load_name(DELTA, source_id, "parked", name))
                remove_path(spark, folder)

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        pages = with_adaptive_execution(batch)
        at = reached(spark)
        if kind == DELTA and (at is None or at["phase"] != DELTA_TAIL):
            if parked is None:
                raise ValueError(f"deltas of {source_id} wait for its snapshot")
            # Batches of one query come in order of their numbers; queries in order of their start.
            folder = f"{parked}/{directory_key_text(source_id)}/batch={started}-{batch_id:012d}"
            pages.write.mode("overwrite").parquet(folder)
            at = reached(spark)
            if at is not None and at["phase"] == DELTA_TAIL:
                release(spark)  # the snapshot was completed in the meantime
            return
        if kind == DELTA and parked is not None:
            release(spark)
        write(pages, kind, load_name(kind, source_id, query_id(spark), batch_id))
        at = reached(spark)
        if kind != DELTA and parked is not None and at is not None and at["phase"] == DELTA_TAIL:
            release(spark)

    started = f"{time.time_ns():020d}"
    writer = pages.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    if continuous_every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=continuous_every).start()
