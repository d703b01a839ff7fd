"""Monitoring queries over the checkpoint history and the table listings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.functions.names import logical_name
from tidefold.operators.checkpoints import checkpoint_writes, latest_checkpoints
from tidefold.operators.select import is_listed_table


def lag_minutes(updated_at: Column | str, now: datetime | Column | None = None) -> Column:
    """Whole seconds since a checkpoint, in minutes with two decimals."""
    if now is None:
        now = F.current_timestamp()
    elif isinstance(now, datetime):
        now = F.lit(now)
    updated_at = F.col(updated_at) if isinstance(updated_at, str) else updated_at
    return F.round((F.unix_timestamp(now) - F.unix_timestamp(updated_at)) / F.lit(60.0), 2)


def listed_tables(listing: DataFrame) -> DataFrame:
    return listing.where(is_listed_table())


def table_count(listing: DataFrame, name: str) -> DataFrame:
    """Distinct tables of a layer, as one row."""
    return listed_tables(listing).agg(F.count_distinct("table_name").alias(name))


def sync_summary(
    history: DataFrame, bronze: DataFrame, silver: DataFrame, now: datetime | Column | None = None
) -> DataFrame:
    """Per source: latest checkpoint, its lag and number of writes, and the layers' table counts.

    The two counts are scalar subqueries, so nothing is cross-joined.
    """
    latest = latest_checkpoints(history).select("source_id", "phase", "updated_at")
    joined = latest.join(checkpoint_writes(history), "source_id", "left")
    return joined.select(
        "source_id",
        "phase",
        "updated_at",
        lag_minutes("updated_at", now).alias("checkpoint_lag_minutes"),
        F.coalesce("checkpoint_write_count", F.lit(0)).alias("checkpoint_write_count"),
        table_count(bronze, "n").scalar().alias("bronze_table_count"),
        table_count(silver, "n").scalar().alias("silver_table_count"),
    )


def dashboard_measures(summary: DataFrame) -> DataFrame:
    names = ["bronze_table_count", "silver_table_count", "checkpoint_lag_minutes", "checkpoint_write_count"]
    return summary.agg(*[F.max(name).alias(name) for name in names])


def _layer(listing: DataFrame, layer: str, logical: Column) -> DataFrame:
    rolled = listed_tables(listing).groupBy(logical.alias("logical_table"), "table_name")
    return rolled.agg(
        F.concat_ws(", ", F.array_sort(F.collect_set("table_type"))).alias(f"{layer}_type"),
        F.min("created").alias(f"{layer}_created"),
        F.max("last_altered").alias(f"{layer}_last_altered"),
    ).withColumnRenamed("table_name", f"{layer}_table")


def table_inventory(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """One row per logical table with its bronze and silver side.

    Listings hold table_name, table_type, created and last_altered.
    """
    joined = bronze_roll_up(bronze).join(silver_roll_up(silver), "logical_table", "full")
    return joined.select(
        "logical_table",
        "bronze_table",
        "silver_table",
        "bronze_type",
        "silver_type",
        "bronze_last_altered",
        "silver_last_altered",
    ).orderBy("logical_table")


def bronze_roll_up(listing: DataFrame) -> DataFrame:
    return _layer(listing, "bronze", logical_name("table_name"))


def silver_roll_up(listing: DataFrame) -> DataFrame:
    return _layer(listing, "silver", F.col("table_name"))


def table_row_counts(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Rows of every logical table on both sides; NULL where a side has no such table.

    Inputs are row sets with a `table_name` column, or ready counts (table_name, row_count).
    """
    left = rows_per_table(bronze).select(
        logical_name("table_name").alias("logical_table"),
        F.col("table_name").alias("bronze_table"),
        F.col("row_count").alias("bronze_row_count"),
    )
    right = rows_per_table(silver).select(
        F.col("table_name").alias("logical_table"),
        F.col("table_name").alias("silver_table"),
        F.col("row_count").alias("silver_row_count"),
    )
    return left.join(right, "logical_table", "full").orderBy("logical_table")


def logical_table_names(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Names of all logical tables that either layer lists."""
    left = bronze.select(logical_name("table_name").alias("logical_table"))
    return left.union(silver.select(F.col("table_name").alias("logical_table"))).distinct()


def rows_per_table(rows: DataFrame) -> DataFrame:
    """Rows of each table of one layer; ready counts pass unchanged."""
    if "row_count" in rows.columns:
        return rows.select("table_name", "row_count")
    return rows.groupBy("table_name").agg(F.count("*").alias("row_count"))


def count_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of separately stored tables, as one union of one-row counts; typed and empty without tables."""
    counts: DataFrame | None = None
    for name, rows in sorted(tables.items()):
        one = rows.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    if counts is None:
        return spark.createDataFrame([], "table_name string, row_count bigint")
    return counts
