"""Helpers the operators share."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.session import scratch_path

# The characters that part words: blank, tab, line feed, vertical tab, form feed, carriage
# return. `bytes.split()` without arguments parts at exactly these.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` below the shared folder and read it back.

    This cuts the lineage: what follows survives lost executors without repeating what came
    before, and a join on the result gets an exchange of its own, which adaptive execution
    can split when a key is hot.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_caches: list[dict] = []


def worker_cache(cache: dict) -> dict:
    """A cache that lives as long as its Python worker; `sole_cache` may empty it."""
    _caches.append(cache)
    return cache


def sole_cache(cache: dict | None = None) -> None:
    """Empty all other caches of this worker.

    Workers are reused from stage to stage, so what one operator remembers would lie there while
    others run. Within a stage the tasks of a worker share a cache.
    """
    emptied = [other.clear() for other in _caches if other is not cache and other]
    if emptied:
        gc.collect()


def utf8(column: str) -> Column:
    """Whole text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(f"`{column}`"), F.lit("")).cast("binary")


def let(value: Column, body) -> Column:
    """`body(value)` with `value` evaluated once.

    Catalyst may inline a projection into a lambda, where it would run once per element; a
    lambda variable is never inlined.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
