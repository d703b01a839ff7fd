"""Landed page envelopes: snapshot pages and delta pages, batch or stream.

A page is one JSON object. Snapshot pages come in path order; those that share a file, one per
line, are numbered by `sequence`, from 0. Delta pages carry their own order and may share files,
too. Document values are read as raw text, so numbers keep the form they were sent in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.functions.names import batch_name
from tidefold.schemas import DELTA_TAIL, INITIAL_SNAPSHOT

SNAPSHOT_ENVELOPE = "values array<string>, hasMore boolean, snapshot bigint, cursor string, sequence bigint"
DELTA_ENVELOPE = "values array<string>, hasMore boolean, cursor bigint"

SNAPSHOT, DELTA = "snapshot", "delta"
_ENVELOPES = {SNAPSHOT: SNAPSHOT_ENVELOPE, DELTA: DELTA_ENVELOPE}
# Snapshot pages carry an opaque cursor, so landing order (the file path and the number in it) is
# their order; delta cursors are ordered themselves.
PAGE_ORDER = {SNAPSHOT: "place", DELTA: "cursor"}


def read_pages(spark: SparkSession, path: str | Sequence[str], kind: str, multi_line: bool = False) -> DataFrame:
    """One row per page of a folder or of listed files: values, has_more, cursor, page_file; snapshot and place for snapshot pages.

    A page that is not the JSON it should be fails the job.
    """
    reader = spark.read.schema(_ENVELOPES[kind]).option("mode", "FAILFAST").option("multiLine", multi_line)
    return _named(reader.option("recursiveFileLookup", True).json(path), kind)


def stream_pages(spark: SparkSession, path: str, kind: str, max_files: int = 100) -> DataFrame:
    """The same rows as a stream that picks up newly landed files."""
    reader = spark.readStream.schema(_ENVELOPES[kind]).option("mode", "FAILFAST").option("recursiveFileLookup", True)
    return _named(reader.option("maxFilesPerTrigger", max_files).json(path), kind)


def _named(pages: DataFrame, kind: str) -> DataFrame:
    named = pages.withColumn("page_file", plain_file("_metadata.file_path")).withColumnRenamed("hasMore", "has_more")
    return named if kind == DELTA else named.withColumn("place", place_of("page_file", F.col("sequence"))).drop("sequence")


def place_of(page_file: str, sequence: Column) -> Column:
    """Text that sorts as the file and the number in it do: no character of a file's URI comes before the blank."""
    return F.concat(page_file, F.lit(" "), F.lpad(F.coalesce(sequence, F.lit(0)).cast("string"), 19, "0"))


def plain_file(name: str) -> Column:
    """Name of a file in one form; Spark writes those of the local file system with one slash or three."""
    return F.regexp_replace(name, "^file:/+", "file:/")


def documents(pages: DataFrame, table: str | None = None) -> DataFrame:
    """One row per document: the page's own columns, `position` in the page, raw `value`.

    `table` restricts the result to one table; None or an empty string means all of them.
    """
    carried = [name for name in pages.columns if name != "values"]
    rows = pages.select(*carried, F.posexplode("values").alias("position", "value")).withColumn(
        "position", F.col("position").cast("bigint")
    )
    if table:
        rows = rows.where(F.get_json_object("value", "$._table") == table)
    return rows


def with_checkpoint(pages: DataFrame, kind: str) -> DataFrame:
    """Add the checkpoint that each page leads to, and the name of its batch.

    A snapshot page with more to come needs a cursor. The last snapshot page hands over to
    the delta tail, which starts at the snapshot's own timestamp.
    """
    if kind == DELTA:
        phase, snapshot = F.lit(DELTA_TAIL), F.lit(None).cast("bigint")
        snapshot_cursor, delta_cursor = F.lit(None).cast("string"), F.col("cursor")
    else:
        more = F.col("has_more")
        missing: Column = F.raise_error(F.lit("snapshot page has more data but no cursor")).cast("string")
        phase = F.when(more, INITIAL_SNAPSHOT).otherwise(DELTA_TAIL)
        snapshot = F.when(more, F.col("snapshot"))
        snapshot_cursor = F.when(more, F.coalesce(F.col("cursor"), missing))
        delta_cursor = F.when(~more, F.col("snapshot"))
    staged = (
        pages.withColumn("phase", phase)
        .withColumn("snapshot_ts", snapshot)
        .withColumn("snapshot_cursor", snapshot_cursor)
        .withColumn("delta_cursor", delta_cursor)
    )
    name = batch_name(F.col("phase"), F.col("snapshot_ts"), F.col("snapshot_cursor"), F.col("delta_cursor"))
    return staged.withColumn("batch", name)


def pages_after(
    pages: DataFrame, order: str, after: object = None, max_pages: int | None = None, past_ends: bool = False
) -> DataFrame:
    """Pages past a cursor, up to the first one that says there is no more, at most `max_pages`.

    Every poll of a delta feed ends in such a page, so a backlog of polls has many of them;
    `past_ends` reads on behind them to the last page that has landed. The bounds are found on the order column alone; page contents stay where they are.
    """
    if max_pages is not None and max_pages <= 0:
        raise ValueError(f"max_pages must be positive, got {max_pages}")
    pending = pages if after is None else pages.where(F.col(order) > F.lit(after))
    if not past_ends:
        final = pending.where(~F.col("has_more")).agg(F.min(order).alias("bound"))
        pending = pending.where(F.col(order) <= F.coalesce(final.scalar(), F.col(order)))
    if max_pages is not None:
        reached = pending.select(order).orderBy(order).limit(max_pages).agg(F.max(order).alias("bound"))
        pending = pending.where(F.col(order) <= reached.scalar())
    return pending


def page_summary(pages: DataFrame, order: str) -> DataFrame:
    """One row: pages_fetched, documents, and cursor and has_more of the last page."""
    return pages.agg(
        F.count("*").alias("pages_fetched"),
        F.coalesce(F.sum(F.size("values")), F.lit(0)).alias("events"),
        F.max_by("cursor", order).alias("cursor"),
        F.coalesce(F.max_by("has_more", order), F.lit(False)).alias("has_more"),
    )
