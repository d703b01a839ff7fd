"""Schema catalog: one row per source table with its JSON schema and fingerprint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.functions.jsontext import canonical_json, object_entries, parse_marked, unmark_decimals, unmark_text
from tidefold.operators.digest import digest_text, sha_number
from tidefold.schemas import CATALOG_SCHEMA
from tidefold.session import path_exists


def catalog_from_payload(payload: DataFrame, column: str = "value") -> DataFrame:
    """Catalog rows of a schemas payload: JSON text that maps table names to schemas.

    A payload that is not an object is an empty catalog; names with a leading `$` are
    internal and left out.
    """
    tables = payload.select(
        F.explode(object_entries(parse_marked(column))).alias("table_name", "schema")
    ).where(~F.col("table_name").startswith("$"))
    text = tables.select(unmark_text(F.col("table_name")).alias("table_name"), unmark_decimals(F.to_json("schema")).alias("schema_json"))
    return with_fingerprints(text)


def with_fingerprints(tables: DataFrame) -> DataFrame:
    """Fingerprint of each schema: SHA-256 of its canonical text."""
    canonical = tables.withColumn("schema_json", canonical_json("schema_json"))
    return canonical.withColumn("fingerprint", F.sha2("schema_json", 256)).select(*CATALOG_SCHEMA.fieldNames())


def read_schema_file(spark: SparkSession, path: str) -> DataFrame:
    """Catalog of a landed schemas payload."""
    return catalog_from_payload(spark.read.text(path, wholetext=True))


def payload_hash(payload: DataFrame, column: str = "value") -> DataFrame:
    """SHA-256 of the whole payload in canonical form."""
    return payload.select(F.sha2(canonical_json(column), 256).alias("schema_hash"))


def write_catalog(catalog: DataFrame, path: str) -> None:
    """Persist the catalog; a run does this before it writes any events."""
    catalog.select(*CATALOG_SCHEMA.fieldNames()).write.mode("overwrite").parquet(path)


def read_catalog(spark: SparkSession, path: str) -> DataFrame | None:
    """The persisted catalog, or None when there is none."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        return None
    return spark.read.schema(CATALOG_SCHEMA).parquet(path)


def catalog_hash(catalog: DataFrame | None) -> str | None:
    """One hash over all tables and schemas, whatever their order; None without a catalog."""
    if catalog is None:
        return None
    number = sha_number(F.concat_ws("\n", "table_name", "fingerprint")).cast("decimal(38,0)")
    summed = catalog.agg(F.count("*").alias("n"), F.coalesce(F.sum(number), F.lit(0)).alias("s"))
    return summed.select(digest_text(F.col("n"), F.col("s")).alias("h")).first()["h"]
