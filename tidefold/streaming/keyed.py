"""Type-1 apply with keyed state: one state-store entry per document, tombstones included.

Each micro-batch brings a document's changes to the task that holds its entry. The entry is the
greatest change so far by the order of events, so late changes lose, repeated ones change nothing,
and a delete stays as a tombstone that later finds of older upserts cannot undo. Only documents
of the batch are touched; nothing is compacted or rewritten. The state store keeps versions with
the query's checkpoint and recovers them when executors are lost; the current table is read from there.

A task reads the changes of a document as they come and holds the greatest alone, so a hot document
costs time in proportion to its changes in the batch, which the stream bounds, and no memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues

_KEYS = ["target", "component_path", "table_name", "document_id"]
_ORDER = ["timestamp", "batch", "position"]
_VALUE = T.StructType([
    T.StructField("timestamp", T.LongType()), T.StructField("batch", T.StringType()), T.StructField("position", T.LongType()),
    T.StructField("deleted", T.BooleanType()), T.StructField("document", T.StringType()),
])
CHANGE_SCHEMA = T.StructType([*[T.StructField(k, T.StringType()) for k in _KEYS], *_VALUE.fields])
_STATE = "last"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LatestChange(StatefulProcessor):
    """Keeps the greatest change of a document and passes it on whenever it is replaced."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState(_STATE, _VALUE)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last = self._last.get() if self._last.exists() else None
        best, at = None, None if last is None else tuple(last[:3])
        for frame in rows:
            for change in frame[_VALUE.names].itertuples(index=False, name=None):
                order = (int(change[0]), change[1], int(change[2]))
                if at is None or order > at:
                    at, best = order, (*order, bool(change[3]), None if pd.isna(change[4]) else change[4])
        if best is not None:
            self._last.update(best)
            yield pd.DataFrame([(*key, *best)], columns=CHANGE_SCHEMA.names)

    def close(self) -> None:
        pass


def keyed_changes(bronze: DataFrame) -> DataFrame:
    """Bronze rows as changes of `CHANGE_SCHEMA`."""
    return bronze.select(
        "target", F.col("_cdc_source_component").alias("component_path"), F.col("_cdc_source_table").alias("table_name"),
        F.col("_cdc_document_id").alias("document_id"), F.col("_cdc_sequence_num").alias("timestamp"), "batch", "position",
        F.coalesce("_cdc_is_deleted", F.lit(False)).alias("deleted"), F.col("_cdc_raw_document_json").alias("document"),
    )


def start(changes: DataFrame, checkpoint: str, feed: str, continuous_every: str | None = None) -> StreamingQuery:
    """Apply a stream of `keyed_changes`; entries that were replaced are written to `feed`, a folder per batch."""
    spark = changes.sparkSession
    replaced = changes.groupBy(*_KEYS).transformWithStateInPandas(
        LatestChange(), CHANGE_SCHEMA, outputMode="Update", timeMode="None"
    )

    def land(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{feed}/batch_id={batch_id:012d}")

    writer = replaced.writeStream.outputMode("update").foreachBatch(land).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if continuous_every is None else writer.trigger(processingTime=continuous_every)
    before = spark.conf.get(_PROVIDER)
    # Read when the query starts; other queries of the session keep theirs.
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        return writer.start()
    finally:
        spark.conf.set(_PROVIDER, before)


def entries(spark: SparkSession, checkpoint: str) -> DataFrame:
    """All entries as of the last complete batch, tombstones included."""
    stored = spark.read.format("statestore").option("stateVarName", _STATE).load(checkpoint)
    return stored.select(*[F.col(f"key.{k}").alias(k) for k in _KEYS], *[F.col(f"value.{v}").alias(v) for v in _VALUE.names])


def current(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Documents that exist."""
    return entries(spark, checkpoint).where(~F.col("deleted") & F.col("document").isNotNull())
