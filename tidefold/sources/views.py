"""Views over published tables, and the catalog listing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LISTING = "table_name string, table_type string"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def register_parquet_view(spark: SparkSession, name: str, uri: str, database: str | None = None) -> None:
    """`CREATE OR REPLACE VIEW` over a parquet location; a temporary view without a database."""
    source = f"SELECT * FROM parquet.{quoted(uri)}"
    if database is None:
        spark.sql(f"CREATE OR REPLACE TEMP VIEW {quoted(name)} AS {source}")
    else:
        spark.sql(f"CREATE OR REPLACE VIEW {quoted(database)}.{quoted(name)} AS {source}")


def register_views(
    spark: SparkSession, tables: Iterable[tuple[str, str]], database: str | None = None, registry: str | None = None
) -> list[str]:
    """Register (view name, uri) pairs; two tables may not end up under one name.

    With `registry`, a folder, each registration is recorded with its time.
    """
    names: dict[str, str] = {}
    for name, uri in tables:
        if name.lower() in names and names[name.lower()] != uri:
            raise ValueError(f"two published tables map to the view name {name}")
        names[name.lower()] = uri
        register_parquet_view(spark, name, uri, database)
    if registry is not None and names:
        # The catalog keeps names in lower case.
        rows = spark.createDataFrame([(database, name) for name in sorted(names)], "database string, table_name string")
        rows.coalesce(1).withColumn("at", F.current_timestamp()).write.mode("append").parquet(registry)
    return sorted(names)


def list_tables(spark: SparkSession, database: str | None = None, registry: str | None = None) -> DataFrame:
    """Tables and views of a schema. The listing is catalog metadata, not data.

    Spark's catalog does not say when a table was made or changed. With `registry` the listing
    has `created` and `last_altered`, the first and the last registration; NULL for tables
    that were registered elsewhere.
    """
    rows = [(table.name, table.tableType) for table in spark.catalog.listTables(database)]
    listing = spark.createDataFrame(rows, _LISTING)
    if registry is None:
        return listing
    recorded = spark.read.parquet(registry).where(F.col("database").eqNullSafe(F.lit(database)))
    times = recorded.groupBy(F.lower("table_name").alias("registered")).agg(
        F.min("at").alias("created"), F.max("at").alias("last_altered")
    )
    return listing.join(times, F.lower("table_name") == F.col("registered"), "left").drop("registered")
