"""Mixing sources to target weights by Poisson replication.

Every source has a rate: the mean number of times each of its documents is repeated so that
the source reaches its share of the mixed corpus. A document's count is the quantile of the
Poisson distribution with that rate at a uniform number seeded by the document's identifier,
so the same document has the same count in every run. Documents are exploded by their counts
and dealt to partitions by a hash of identifier and copy, sorted by it within them: a global
shuffle with one exchange. Everything is DataFrame code.

Defined cases: a null source is a source of its own; a null text counts as empty, and a text's
size is its characters plus one; a null identifier is seeded as text `null`; rows that repeat
an identifier have the same count; sources without a target weight, or with weight zero, leave
the mix; an empty table gives no rows; input columns named like the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidefold.llm.common import materialise
from tidefold.session import broadcast_if_bounded

SEED = "mix-1"
SMOOTHING = 0.5
EPOCHS = 1.0


def _uniform(id_col: str, seed: str) -> Column:
    """A number in [0, 1) from 52 bits of the seeded digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, source_col: str = "source", text_col: str = "text",
                 weights: DataFrame | None = None, smoothing: float = SMOOTHING, epochs: float = EPOCHS) -> DataFrame:
    """One row per source: mix_source, rate (mean repetitions of its documents).

    `weights(source, weight)` gives the targets; without it, a source's weight is its size to
    the power `smoothing`. `epochs` is the size of the mix over the size of the input.
    """
    size = F.length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))) + 1
    sizes = materialise(
        docs.groupBy(F.col(f"`{source_col}`").alias("mix_source")).agg(F.sum(size).cast("double").alias("size")),
        "mix-sizes",
    )
    if weights is None:
        weighted = sizes.withColumn("weight", F.pow("size", F.lit(smoothing)))
    else:
        target = weights.select(F.col("source").alias("target"), F.col("weight").cast("double").alias("weight"))
        weighted = sizes.join(target, F.col("mix_source").eqNullSafe(F.col("target"))).where("weight > 0")
    all_size = sizes.agg(F.sum("size")).first()[0]
    all_weight = weighted.agg(F.sum("weight")).first()[0]
    if not all_size or not all_weight:
        return weighted.select("mix_source", F.lit(0.0).alias("rate")).where("false")
    return weighted.select(
        "mix_source", (F.col("weight") / F.lit(all_weight) * F.lit(epochs) * F.lit(all_size) / F.col("size")).alias("rate")
    )


def poisson_table(rates: DataFrame) -> DataFrame:
    """Rows (mix_source, cdf): the cumulative Poisson probabilities of each rate, far into the tail."""
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    terms = rates.select("mix_source", "rate", F.explode(F.sequence(F.lit(0), last)).alias("k"))
    so_far = W.partitionBy("mix_source").orderBy("k")
    return (
        terms.withColumn("log_factorial", F.sum(F.when(F.col("k") > 0, F.log(F.col("k").cast("double"))).otherwise(0.0)).over(so_far))
        .withColumn("term", F.exp(F.col("k") * F.log("rate") - F.col("rate") - F.col("log_factorial")))
        .withColumn("cumulative", F.sum("term").over(so_far))
        .groupBy("mix_source").agg(F.array_sort(F.collect_list("cumulative")).alias("cdf"))
    )


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: DataFrame | None = None, smoothing: float = SMOOTHING, epochs: float = EPOCHS,
        seed: str = SEED) -> DataFrame:
    """The input's columns for every repetition, with `copy` (from 0) and `mix_key` (order of the shuffle).

    The table of rates has a row per source; it is broadcast only when measured to be small,
    else joined by a shuffle whose hot source adaptive execution splits.
    """
    tables = materialise(poisson_table(source_rates(docs, source_col, text_col, weights, smoothing, epochs)), "mix-cdf")
    kept = [F.col(f"`{name}`") for name in docs.columns if name not in ("copy", "mix_key")]
    below = F.size(F.filter("cdf", lambda c: c <= _uniform(id_col, seed)))
    counted = docs.join(
        broadcast_if_bounded(tables), F.col(f"`{source_col}`").eqNullSafe(F.col("mix_source"))
    ).select(*kept, below.alias("mix_count"))
    key = F.md5(F.concat_ws(":", F.lit(f"{seed}-order"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")), F.col("copy")))
    copies = counted.where("mix_count > 0").select(
        *kept, F.explode(F.sequence(F.lit(0), F.col("mix_count") - 1)).alias("copy")
    )
    return copies.withColumn("mix_key", key).repartition("mix_key").sortWithinPartitions("mix_key")


# The query's SQL: the same rates, digests and quantiles.
MIX_SQL = f"""
WITH sizes AS (
  SELECT source, sum(length(coalesce(text, '')) + 1)::DOUBLE AS size FROM documents GROUP BY source
), rates AS (
  SELECT source,
         pow(size, {SMOOTHING}) / (SELECT sum(pow(size, {SMOOTHING})) FROM sizes)
           * {EPOCHS} * (SELECT sum(size) FROM sizes) / size AS rate
  FROM sizes
), terms AS (
  SELECT source, rate, unnest(range(0, (ceil(rate + 12 * sqrt(rate) + 30))::BIGINT + 1)) AS k FROM rates
), factorials AS (
  SELECT source, rate, k,
         sum(CASE WHEN k > 0 THEN ln(k::DOUBLE) ELSE 0 END) OVER (PARTITION BY source ORDER BY k) AS log_factorial
  FROM terms
), cumulated AS (
  SELECT source, k,
         sum(exp(k * ln(rate) - rate - log_factorial)) OVER (PARTITION BY source ORDER BY k) AS cumulative
  FROM factorials
), tables AS (
  SELECT source, list(cumulative ORDER BY k) AS cdf FROM cumulated GROUP BY source
), counted AS (
  SELECT d.*, len(list_filter(t.cdf, lambda c: c <=
           ('0x' || substr(md5('{SEED}:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0)) AS n
  FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source
), copies AS (
  SELECT *, unnest(range(0, n)) AS copy FROM counted WHERE n > 0
)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy,
       md5('{SEED}-order:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy::VARCHAR) AS mix_key
FROM copies
"""
