"""Registered queries: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.llm.common import materialise, table
from tidefold.llm.decontamination import DECONTAMINATION_SQL, decontaminate
from tidefold.llm.divergence import DIVERGENCE_SQL, source_divergence
from tidefold.llm.exact_dedup import exact_dedup
from tidefold.llm.hard_negatives import HARD_NEGATIVES_SQL, hard_negatives
from tidefold.llm.mixing import MIX_SQL, mix
from tidefold.llm.packing import pack
from tidefold.llm.quotes import link_quotes
from tidefold.llm.simhash import simhash_components
from tidefold.llm.suffix_dedup import remove_repeats
from tidefold.llm.token_output import token_output
from tidefold.llm.token_scan import token_counts
from tidefold.llm.toxicity import toxicity
from tidefold.llm.weak_rules import weak_quality

QUERIES = {}
ORACLES = {}


def query(name: str, oracle: str | None = None):
    def add(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return add


@query("op1_poisson_mixing", MIX_SQL)
def op1_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


@query("op2_patricia_exact_dedup", """
WITH keyed AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM keyed WINDOW same AS (PARTITION BY body)
""")
def op2_patricia_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op5_ftrl_toxicity")
def op5_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_simhash_multi_index")
def op6_simhash_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


@query("op9_swap_packing")
def op9_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def quoting_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as mail: each turn quotes the one before, and that one's quote a level deeper."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id", "turn").agg(
        F.min(F.coalesce("text", F.lit(""))).alias("text")
    )
    turns = materialise(turns, "mail-turns")
    one = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("one_before"))
    two = turns.select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("text").alias("two_before"))
    quoted = turns.join(one, ["conv_id", "turn"], "left").join(two, ["conv_id", "turn"], "left")

    def quote(column: str, marks: str):
        return F.concat(F.lit(marks), F.replace(F.col(column), F.lit("\n"), F.lit("\n" + marks)), F.lit("\n"))

    return quoted.select(
        F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), F.struct("conv_id", "turn")).alias("id"), F.col("conv_id").cast("string").alias("thread"),
        F.concat(
            F.coalesce(F.when(F.col("one_before").isNotNull(), quote("two_before", "> > ")), F.lit("")),
            F.coalesce(quote("one_before", "> "), F.lit("")), "text",
        ).alias("text"),
    )


@query("op3_quotation_linking", r"""
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, min(coalesce(text, '')) AS text FROM conversations GROUP BY conv_id, turn
), plain AS (
  SELECT *, trim(regexp_replace(lower(text), '[\x20\x09-\x0D]+', ' ', 'g')) AS body_key FROM turns
), linked AS (
  SELECT m.conv_id, m.turn, m.text, p.turn IS NOT NULL AS quotes, q.turn IS NOT NULL AS quotes_two,
         CASE WHEN p.body_key <> '' THEN
           (SELECT min(o.turn) FROM plain o WHERE o.conv_id = m.conv_id AND o.body_key = p.body_key AND o.turn < m.turn)
         END AS parent_turn
  FROM plain m
  LEFT JOIN plain p ON p.conv_id = m.conv_id AND p.turn = m.turn - 1
  LEFT JOIN plain q ON q.conv_id = m.conv_id AND q.turn = m.turn - 2
), walk AS (
  SELECT conv_id, turn, turn AS root_turn, 0 AS depth FROM linked WHERE parent_turn IS NULL
  UNION ALL
  SELECT l.conv_id, l.turn, w.root_turn, w.depth + 1 FROM linked l JOIN walk w ON w.conv_id = l.conv_id AND w.turn = l.parent_turn
)
SELECT l.conv_id * 1000000 + l.turn AS id, l.conv_id * 1000000 + l.parent_turn AS parent,
       w.conv_id * 1000000 + w.root_turn AS conversation, w.depth,
       CASE WHEN quotes THEN 1 + quotes_two::INTEGER ELSE 0 END AS n_quoted, l.text AS body
FROM linked l JOIN walk w USING (conv_id, turn)
""")
def op3_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = link_quotes(quoting_messages(spark, sf_dir), blank_answers=True)

    def number(name: str):
        """As the SQL numbers messages; from turn 1,000,000 on only conversation and turn tell them apart."""
        return (F.col(f"{name}.conv_id") * 1_000_000 + F.col(f"{name}.turn")).alias(name)

    return linked.select(number("id"), number("parent"), number("conversation"), "depth", "n_quoted", "body")


@query("op4_separator_scan")
def op4_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=49407)


@query("op7_suffix_dedup")
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


@query("op8_weak_supervision")
def op8_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality(table(spark, sf_dir, "documents"))


@query("op10_token_output")
def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@query("op11_hard_negatives", HARD_NEGATIVES_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    )
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


@query("op12_source_divergence", DIVERGENCE_SQL)
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


@query("op13_decontamination", DECONTAMINATION_SQL)
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
