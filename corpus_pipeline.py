"""The corpus pipeline: documents in, packed sequences out, one operator per stage.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the
last return the columns of documents, extra ones included.

Defined cases: null and empty texts are documents like any other (not toxic, equal to each
other, near copies of each other); rows are told apart by doc_id, null being an identifier too, and
rows that share one by their text, so one row of each group stays; an empty table passes as an
empty table.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidefold.llm.common import materialise, table
from tidefold.llm.exact_dedup import exact_dedup
from tidefold.llm.mixing import mix
from tidefold.llm.near_copies import near_copies, node_of
from tidefold.llm.packing import pack
from tidefold.llm.toxicity import toxicity_score, train_toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; the model learns from the labelled ones among them."""
    model = train_toxicity(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity_score(docs, model) < 0.5)


@F.pandas_udf(StringType())
def _content(body: pd.Series) -> pd.Series:
    """The text_sha256 of exact_dedup."""
    return body.map(lambda text: hashlib.sha256(text.lower()).hexdigest())


def _identified(docs: DataFrame, *more: Column) -> DataFrame:
    """Rows (row, id, more): whole rows and their identifier, null being one too."""
    doc_id = docs["doc_id"].cast("long")
    return docs.select(F.struct("*").alias("row"), F.struct(doc_id.isNull(), F.coalesce(doc_id, F.lit(0))).alias("id"), *more)


def _repeated(rows: DataFrame, label: str) -> DataFrame:
    return materialise(rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), label)


def _one_each(rows: DataFrame, *key: str) -> DataFrame:
    """One of the rows that share `key`."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*key).orderBy("row.text"))).where("place = 1")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays, one row of it."""
    rows = _identified(docs)
    kept = exact_dedup(docs).where("kept").select(
        F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0))).alias("id"), F.col("text_sha256").alias("content")
    )
    kept = materialise(kept, "pipeline-exact")
    repeated = _repeated(rows, "pipeline-exact-ids")
    if repeated.isEmpty():
        return rows.join(kept, "id", "left_semi").select("row.*")
    once = rows.join(repeated, "id", "left_anti").join(kept, "id", "left_semi")
    often = rows.join(repeated, "id", "left_semi").withColumn("content", _content(F.coalesce("row.text", F.lit("")).cast("binary")))
    often = _one_each(often.join(kept, ["id", "content"], "left_semi"), "id", "content")
    return once.select("row.*").union(often.select("row.*"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document goes if one with a smaller doc_id stays that has 0.8 of their five-word shingles in common.

    Rows that share doc_id and text are one document, of which one row stays.
    """
    rows = _identified(docs, node_of(docs).alias("node"))
    left = rows.join(near_copies(docs), "node", "left_anti")
    repeated = _repeated(rows, "pipeline-near-ids")
    if repeated.isEmpty():
        return left.select("row.*")
    once = left.join(repeated, "id", "left_anti").select("row.*")
    return once.union(_one_each(left.join(repeated, "id", "left_semi"), "node").select("row.*"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources reach their target weights, in random order."""
    return mix(docs).select([F.col(f"`{name}`") for name in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed into sequences of 2048 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("poisson_mixing", mix_sources),
    ("swap_packing", pack_sequences),
]

# Hash features, fingerprints and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
