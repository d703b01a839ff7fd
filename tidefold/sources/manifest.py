"""Publish manifests and table inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.schemas import MANIFEST_ENTRY_COLUMNS, MANIFEST_SCHEMA, MANIFEST_VERSION
from tidefold.session import list_names, path_exists

_ENTRY = "relative_path string, current_key string, versioned_key string, sha256 string, bytes bigint"
_DOCUMENT = (
    "version bigint, publish_id string, published_at_epoch_ms bigint, bucket string, prefix string, "
    f"tables map<string, struct<{_ENTRY.replace(' ', ': ').replace(',: ', ', ')}>>"
)


def read_manifest_document(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a manifest that is one JSON object with a `tables` map."""
    document = spark.read.schema(_DOCUMENT).option("multiLine", True).json(path)
    entries = document.select("*", F.explode("tables").alias("_path", "entry"))
    return entries.select(
        "version", "publish_id", "published_at_epoch_ms", "bucket", "prefix",
        F.col("_path").alias("relative_path"),
        *[F.col(f"entry.{name}").alias(name) for name in MANIFEST_ENTRY_COLUMNS[1:]],
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a manifest written by `write_manifest`; empty when it is absent."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).json(path)


def write_manifest(entries: DataFrame, path: str, publish_id: str, published_at_ms: int, bucket: str, prefix: str) -> None:
    """One JSON line per published table."""
    rows = entries.select(
        F.lit(MANIFEST_VERSION).cast("bigint").alias("version"),
        F.lit(publish_id).alias("publish_id"),
        F.lit(published_at_ms).cast("bigint").alias("published_at_epoch_ms"),
        F.lit(bucket).alias("bucket"),
        F.lit(prefix).alias("prefix"),
        *MANIFEST_ENTRY_COLUMNS,
    )
    rows.write.mode("overwrite").json(path)


def latest_manifest(spark: SparkSession, manifests: str) -> DataFrame:
    """The newest manifest.

    `latest.json` normally is it. Should a publish have died while replacing it, the newest
    complete manifest by id stands in.
    """
    if path_exists(spark, f"{manifests}/latest.json/_SUCCESS"):
        return read_manifest(spark, f"{manifests}/latest.json")
    complete = [
        name
        for name in list_names(spark, manifests)
        if name != "latest.json" and path_exists(spark, f"{manifests}/{name}/_SUCCESS")
    ]
    newest = max(complete, key=lambda name: (len(name), name), default="latest.json")
    return read_manifest(spark, f"{manifests}/{newest}")


def file_inventory(spark: SparkSession, directory: str) -> DataFrame:
    """Parquet files below a directory: relative path, SHA-256 of the bytes, size.

    Meant for files that other programs wrote; a missing directory is an error, other files
    are ignored. Each file is hashed by the task that reads it.
    """
    if not path_exists(spark, directory):
        raise FileNotFoundError(f"{directory} does not exist")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(directory)
    )
    below = F.regexp_replace(F.col("path"), F.lit("^.*?" + _quoted(directory.rstrip("/")) + "/"), F.lit(""))
    return files.select(
        below.alias("relative_path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes")
    )


def _quoted(text: str) -> str:
    return "\\Q" + text.split("://", 1)[-1] + "\\E"
