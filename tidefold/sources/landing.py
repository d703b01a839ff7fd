"""An index of landed pages: what each says of itself, kept so that no page is opened twice for it.

The index is append-only, one row a page: its file, its place in the order of pages, whether more
follow. A refresh lists the names of the landing folder, leaves out those the index has, and
opens only the others. A reader finds the pages that are due in the index and opens only
their files. All rows of a landed file are in one file of the index, so a refresh that dies leaves
a file known as a whole or not at all. A file that is landed anew under an old name is not noticed.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidefold.operators.select import unprocessed
from tidefold.session import glob_escaped, path_exists
from tidefold.sources.pages import DELTA, PAGE_ORDER, SNAPSHOT, pages_after, place_of, plain_file, read_pages

_HEADER = {
    DELTA: "page_file string, has_more boolean, cursor bigint, events bigint",
    SNAPSHOT: "page_file string, has_more boolean, snapshot bigint, cursor string, events bigint, place string",
}


def index_path(control: str, folder: str, kind: str) -> str:
    """Where the pages of a landing folder are indexed: next to the control table, whatever source reads them."""
    return f"{control}-pages/{kind}-{hashlib.sha256(folder.encode()).hexdigest()[:16]}"


def listed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the landed files, without opening any: (page_file)."""
    listing = spark.read.schema("value string").option("recursiveFileLookup", True).text(folder).inputFiles()
    return spark.createDataFrame([(name,) for name in listing], "page_file string").select(plain_file("page_file").alias("page_file"))


def read_index(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The header of every indexed page; of two refreshes that opened the same file at once, one counts."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], _HEADER[kind])
    rows = spark.read.schema(f"{_HEADER[kind]}, refresh string").parquet(path)
    one = rows.withColumn("first", F.min("refresh").over(Window.partitionBy("page_file")))
    one = one.where("refresh = first").drop("refresh", "first")
    if kind == SNAPSHOT:
        # An index from before pages could share files has no places.
        one = one.withColumn("place", F.coalesce("place", place_of("page_file", F.lit(0))))
    return one


def _read_files(spark: SparkSession, folder: str, kind: str, files: Sequence[str], n_listed: int) -> DataFrame:
    """Pages of some of the landed files; with all of them due, of the folder."""
    if len(files) == n_listed:
        return read_pages(spark, folder, kind)
    return read_pages(spark, [glob_escaped(unquote(name)) for name in files], kind)


def refresh_index(spark: SparkSession, folder: str, kind: str, path: str) -> int:
    """Index the files that landed since the last refresh; how many were opened."""
    listed = listed_files(spark, folder)
    unseen = [r["page_file"] for r in unprocessed(listed, read_index(spark, path, kind), "page_file").collect()]
    if unseen:
        pages = _read_files(spark, folder, kind, unseen, listed.count())
        headers = pages.withColumn("events", F.size("values").cast("bigint")).drop("values")
        names = [field.split()[0] for field in _HEADER[kind].split(", ")]
        marked = headers.select(*names, F.lit(uuid.uuid4().hex).alias("refresh"))
        marked.repartition("page_file").write.mode("append").parquet(path)
    return len(unseen)


def due_headers(spark: SparkSession, folder: str, kind: str, path: str, after: object = None, max_pages: int | None = None,
                past_ends: bool = False) -> DataFrame:
    """Headers of the pages past a cursor, from the refreshed index."""
    refresh_index(spark, folder, kind, path)
    return pages_after(read_index(spark, path, kind), PAGE_ORDER[kind], after, max_pages, past_ends)


def read_due(spark: SparkSession, folder: str, kind: str, headers: DataFrame) -> DataFrame:
    """The pages of `headers`, opening only their files."""
    order = PAGE_ORDER[kind]
    files = [row["page_file"] for row in headers.select("page_file").distinct().collect()]
    if not files:
        return read_pages(spark, folder, kind).limit(0)
    bounds = headers.agg(F.min(order).alias("low"), F.max(order).alias("high")).first()
    pages = _read_files(spark, folder, kind, files, listed_files(spark, folder).count())
    return pages.where(F.col(order).between(bounds["low"], bounds["high"]))
