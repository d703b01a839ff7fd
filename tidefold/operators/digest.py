"""Order-free content digests of tables.

File bytes depend on how Spark split the rows, so they say nothing about content. A digest
here is a count and a sum of row hashes: both are partial aggregates of fixed size, the
result does not depend on layout, and, unlike xor, duplicate rows do not cancel out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sha_number(text: Column | str) -> Column:
    """First 60 bits of a text's SHA-256 as a number; any SQL engine can repeat it."""
    text = F.col(text) if isinstance(text, str) else text
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")


def digest_text(rows: Column, hash_sum: Column) -> Column:
    return F.sha2(F.concat_ws(":", rows.cast("string"), hash_sum.cast("string")), 256)


def content_digest(
    df: DataFrame, keys: Sequence[str], row_hash: Column | None = None, also: Sequence[Column] = ()
) -> DataFrame:
    """Per key: `row_count` and `sha256` over the content of all its rows, in one pass.

    `row_hash` gives the hash of one row; the default is xxhash64 over the other columns and,
    because it skips NULLs, over which of them are NULL.
    `also` are further aggregates for the same pass, such as a size.
    """
    if row_hash is None:
        hashed_columns = [F.col(f"`{name}`") for name in df.columns if name not in keys]
        row_hash = F.xxhash64(*hashed_columns, *[column.isNull() for column in hashed_columns])
    hashed = df.withColumn("_hash", row_hash.cast("decimal(38,0)"))
    summed = hashed.groupBy(*keys).agg(F.count("*").alias("row_count"), F.sum("_hash").alias("_sum"), *also)
    digest = digest_text(F.col("row_count"), F.col("_sum")).alias("sha256")
    extra = [name for name in summed.columns if name not in (*keys, "row_count", "_sum")]
    return summed.select(*keys, "row_count", digest, *extra)
