"""Silver layer: current rows kept up to date from a stream of changes.

    changes/micro_batch=<query>.<n>/target=<t>/  latest row per key of one micro-batch, deletes included
    base/version=<v>/target=<t>/                 the fold of everything up to some batch of each query
    held/version=<v>/                            per query, the last batch that base <v> contains

Each micro-batch writes only what it brought; the current state is base plus later changes,
folded on read. Compaction folds them into a new base once the changes have grown to a set
fraction of the base, so the total rewriting stays proportional to the data, however many
micro-batches come. Writing a batch twice replaces it; a base counts once `held` is complete.
Batches are told apart by query, so a stream that starts over with a new checkpoint adds its
changes instead of hiding behind the numbers of the old one.

Rows are stored by target: reading one table scans and folds that table alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tidefold.operators.fold import fold_onto, latest_by
from tidefold.operators.infer import project_bronze
from tidefold.schemas import (
    CDC_DOCUMENT_ID,
    CDC_IS_DELETED,
    CDC_RAW_DOCUMENT_JSON,
    CDC_SEQUENCE_NUM,
    CDC_SOURCE_COMPONENT,
    CDC_SOURCE_TABLE,
)
from tidefold.session import filled_partitions, partition_values, query_id, remove_path, with_adaptive_execution
from tidefold.sources.bronze import bronze_columns

_HELD = "query string, upto bigint"


def _named(batch: str) -> tuple[str, int]:
    query, _, number = batch.rpartition(".")
    return query, int(number)


@dataclass(frozen=True)
class ChangeTable:
    """A stored type-1 table: where it lives, what identifies a row, what orders its changes.

    `partition_by` is one of the keys; rows are stored by it.
    """

    path: str
    keys: Sequence[str]
    sequence_by: Sequence[str]
    delete_when: str
    compact_ratio: float = 0.5
    partition_by: str = "target"

    def fold(self, changes: DataFrame) -> DataFrame:
        return latest_by(changes, self.keys, self.sequence_by)

    def _write(self, rows: DataFrame, name: str) -> None:
        stored = rows.hint("rebalance", self.partition_by).write.mode("overwrite").partitionBy(self.partition_by)
        stored.parquet(f"{self.path}/{name}")

    def _read(self, spark: SparkSession, folder: str, names: Sequence[str], where: Column | None) -> DataFrame:
        """Rows of some batches or bases; None if all of them are empty."""
        root, column = f"{self.path}/{folder}", "micro_batch" if folder == "changes" else "version"
        filled = filled_partitions(spark, root, column, self.partition_by)
        paths = [f"{root}/{column}={name}" for name in names if name in filled]
        if not paths:
            return None
        reader = spark.read.option("basePath", root)
        # Partition values are text, whatever they look like.
        kinds = {f.name: f.dataType for f in reader.parquet(*paths).schema} | {self.partition_by: T.StringType(), column: T.StringType()}
        schema = T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])
        rows = reader.schema(schema).parquet(*paths).drop(column)
        return rows if where is None else rows.where(where)

    def write_batch(self, changes: DataFrame, query: str, batch_id: int) -> None:
        """Store one micro-batch, already reduced to its latest row per key."""
        self._write(self.fold(changes), f"changes/micro_batch={query}.{batch_id:010d}")

    def _base(self, spark: SparkSession) -> tuple[str | None, dict[str, int]]:
        """Newest base and, per query, the last batch it contains."""
        version = max(partition_values(spark, f"{self.path}/held", "version"), default=None)
        if version is None:
            return None, {}
        rows = spark.read.schema(_HELD).parquet(f"{self.path}/held/version={version}").collect()
        return version, {row["query"]: row["upto"] for row in rows}

    def _pending(self, spark: SparkSession, held: dict[str, int]) -> list[str]:
        written = partition_values(spark, f"{self.path}/changes", "micro_batch")
        return [batch for batch in written if _named(batch)[1] > held.get(_named(batch)[0], -1)]

    def state(self, spark: SparkSession, where: Column | None = None) -> DataFrame | None:
        """Latest row per key with tombstones; None before the first batch.

        `where` is a condition on `partition_by`; it reaches the scans, so other partitions
        are neither read nor folded.
        """
        base, held = self._base(spark)
        return self._fold_pending(spark, base, self._pending(spark, held), where)

    def _fold_pending(self, spark: SparkSession, base: str | None, pending: list[str], where: Column | None) -> DataFrame | None:
        settled = None if base is None else self._read(spark, "base", [base], where)
        changes = self._read(spark, "changes", pending, where)
        if changes is None:
            return settled
        if settled is None:
            return self.fold(changes)
        return fold_onto(settled, changes, self.keys, self.sequence_by)

    def current(self, spark: SparkSession, where: Column | None = None) -> DataFrame | None:
        """Rows that exist now."""
        state = self.state(spark, where)
        return None if state is None else state.where(~F.coalesce(F.expr(self.delete_when), F.lit(False)))

    def compact(self, spark: SparkSession, force: bool = False) -> bool:
        """Fold pending changes into a new base if they have grown enough."""
        base, held = self._base(spark)
        pending = self._pending(spark, held)
        if not pending:
            return False
        if not force and base is not None:
            # Row counts come from parquet footers.
            changes = self._read(spark, "changes", pending, None)
            if changes is not None and changes.count() < self.compact_ratio * self._read(spark, "base", [base], None).count():
                return False
        folded = self._fold_pending(spark, base, pending, None)
        if folded is None:
            return False
        version = f"{0 if base is None else int(base) + 1:010d}"
        self._write(folded, f"base/version={version}")
        for batch in pending:
            query, number = _named(batch)
            held[query] = max(number, held.get(query, -1))
        rows = spark.createDataFrame(sorted(held.items()), _HELD)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/held/version={version}")
        return True

    def drop_folded(self, spark: SparkSession) -> int:
        """Delete changes and bases that the newest base already contains."""
        base, held = self._base(spark)
        if base is None:
            return 0
        pending = set(self._pending(spark, held))
        folded = [f"changes/micro_batch={b}" for b in partition_values(spark, f"{self.path}/changes", "micro_batch") if b not in pending]
        folded += [f"{kind}/version={v}" for kind in ("held", "base") for v in partition_values(spark, f"{self.path}/{kind}", "version") if v < base]
        for name in folded:
            remove_path(spark, f"{self.path}/{name}")
        return len(folded)


def start(
    changes: DataFrame, table: ChangeTable, checkpoint: str, continuous_every: str | None = None, compact: bool = True,
    name: str | None = None,
) -> StreamingQuery:
    """Apply a stream of changes to a table.

    Without an interval the query takes everything available and ends; with one it keeps
    running. Late and repeated changes are settled by the sequence, never dropped.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.write_batch(with_adaptive_execution(batch), query_id(batch.sparkSession), batch_id)
        if compact:
            table.compact(batch.sparkSession)

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    if continuous_every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=continuous_every).start()


def silver_table(path: str, compact_ratio: float = 0.5) -> ChangeTable:
    """Store for the rows of all bronze targets, by target.

    The key is the whole identity, so two source tables that share a bronze name stay apart.
    """
    return ChangeTable(
        path=path,
        keys=["target", CDC_SOURCE_COMPONENT, CDC_SOURCE_TABLE, CDC_DOCUMENT_ID],
        sequence_by=[CDC_SEQUENCE_NUM, "batch", "position"],
        delete_when=CDC_IS_DELETED,
        compact_ratio=compact_ratio,
    )


def read_silver(spark: SparkSession, table: ChangeTable, bronze_root: str, target: str) -> DataFrame:
    """Current rows of one silver table: document id and typed user columns."""
    mine = table.current(spark, F.col("target") == target)
    if mine is None:
        raise FileNotFoundError(f"no silver state below {table.path}")
    return project_bronze(mine, CDC_RAW_DOCUMENT_JSON, bronze_columns(spark, bronze_root, target), [CDC_DOCUMENT_ID])


def silver_counts(rows: DataFrame, name: Column | str = "target") -> DataFrame:
    name = F.col(name) if isinstance(name, str) else name
    return rows.groupBy(name.alias("table_name")).agg(F.count("*").alias("row_count"))
