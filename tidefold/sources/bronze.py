"""Bronze layer: append-only change rows of every source table, with evolving columns.

Layout: `rows/load_id=<id>/target=<bronze table>/` and `fields/load_id=<id>/`. Rows keep the
fixed columns, the raw document, and its fields as a variant. Spark writes a variant shredded, so
every user field is a typed column of its own in the files of its table, whatever types other
loads or tables have for it, and reading a field reads that column. The fields of a load, with the
kinds seen, are written next to it. A column's type is decided when a table is read, from the
fields of all its loads: new columns simply appear, and a column that turns from numbers to text
is promoted value by value instead of clashing with older files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidefold.functions.events import bronze_rows
from tidefold.functions.jsontext import flat_fields
from tidefold.functions.kinds import bronze_type
from tidefold.functions.names import BRONZE_PREFIX, bronze_table_name
from tidefold.operators.infer import bronze_fields, project_bronze
from tidefold.schemas import (
    BRONZE_COLUMNS,
    BRONZE_FILE_SCHEMA,
    BRONZE_STORED_SCHEMA,
    BRONZE_TABLE_SCHEMA,
    CDC_FIELDS,
    CDC_RAW_DOCUMENT_JSON,
    CDC_SOURCE_COMPONENT,
    CDC_SOURCE_TABLE,
)
from tidefold.session import list_names, partition_values, remove_path
from tidefold.sources.views import quoted

_FIELDS = "target string, field string, flags int, load_id string"
ORDER_COLUMNS = ["batch", "position"]


def append_bronze(
    events: DataFrame, root: str, load_id: str, source_id: str, run_id: str, prefix: str = BRONZE_PREFIX
) -> DataFrame:
    """Write or replace one load, routed to its target tables: rows per target.

    `events` are normalised events with `creation_time`, `schema_fingerprint`, `batch` and
    `position`. All targets are written by one job; the fields follow from the stored rows,
    so documents are parsed from pages only once.
    """
    spark = events.sparkSession
    target = f"{root}/rows/load_id={load_id}"
    rows = bronze_rows(events, source_id, run_id).withColumns({
        "target": bronze_table_name(CDC_SOURCE_COMPONENT, CDC_SOURCE_TABLE, prefix),
        CDC_FIELDS: flat_fields(CDC_RAW_DOCUMENT_JSON),
    })
    rows.hint("rebalance", "target").write.mode("overwrite").partitionBy("target").parquet(target)
    stored = spark.read.schema(BRONZE_STORED_SCHEMA).parquet(target)
    if not any(name.startswith("target=") for name in list_names(spark, target)):
        remove_path(spark, target)
        return spark.createDataFrame([], "target string, row_count bigint")
    fields = bronze_fields(stored, CDC_RAW_DOCUMENT_JSON, ["target"])
    fields.repartition(1).write.mode("overwrite").parquet(f"{root}/fields/load_id={load_id}")
    return routed_counts(stored)


def routed_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("target").agg(F.count("*").alias("row_count"))


def bronze_loads(spark: SparkSession, root: str) -> list[str]:
    """Loads whose rows and fields are both complete."""
    rows = partition_values(spark, f"{root}/rows", "load_id")
    described = set(partition_values(spark, f"{root}/fields", "load_id"))
    return [load for load in rows if load in described]


def read_bronze_rows(spark: SparkSession, root: str, loads: Sequence[str] | None = None) -> DataFrame:
    """Stored rows of all targets."""
    return _stored(spark, root, BRONZE_STORED_SCHEMA, loads)


def _stored(spark: SparkSession, root: str, schema: StructType, loads: Sequence[str] | None = None) -> DataFrame:
    loads = bronze_loads(spark, root) if loads is None else loads
    if not loads:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", f"{root}/rows")
    return reader.parquet(*[f"{root}/rows/load_id={load}" for load in loads])


def stream_bronze_rows(spark: SparkSession, root: str, max_files: int = 1000) -> DataFrame:
    """The same rows as a stream."""
    reader = spark.readStream.schema(BRONZE_STORED_SCHEMA).option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{root}/rows")


def bronze_columns(spark: SparkSession, root: str, target: str) -> list[tuple[str, str, int]]:
    """User columns of a target as (name, type, flags), over all loads."""
    loads = bronze_loads(spark, root)
    if not loads:
        return []
    reader = spark.read.schema(_FIELDS).option("basePath", f"{root}/fields")
    fields = reader.parquet(*[f"{root}/fields/load_id={load}" for load in loads])
    merged = fields.where(F.col("target") == target).groupBy("field").agg(F.bit_or("flags").alias("flags"))
    rows = merged.select("field", bronze_type("flags").alias("type"), "flags").collect()
    return sorted((row["field"], row["type"], row["flags"]) for row in rows)


def read_bronze(spark: SparkSession, root: str, target: str, with_order: bool = False) -> DataFrame:
    """One bronze table: metadata columns and typed user columns, in name order."""
    rows = _stored(spark, root, BRONZE_TABLE_SCHEMA).where(F.col("target") == target)
    keep = BRONZE_FILE_SCHEMA.fieldNames() if with_order else BRONZE_COLUMNS
    typed = project_bronze(rows, CDC_RAW_DOCUMENT_JSON, bronze_columns(spark, root, target), keep, CDC_FIELDS)
    ordered = sorted(name for name in typed.columns if name not in ORDER_COLUMNS)
    return typed.select(*[quoted(name) for name in ordered], *(ORDER_COLUMNS if with_order else []))


def colliding_targets(rows: DataFrame) -> DataFrame:
    """Targets that more than one source table writes to."""
    sources = rows.select("target", CDC_SOURCE_COMPONENT, CDC_SOURCE_TABLE).distinct()
    return sources.groupBy("target").agg(F.count("*").alias("sources")).where(F.col("sources") > 1)
