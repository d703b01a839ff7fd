"""Toxicity scores by FTRL-proximal logistic regression over hashed word features.

The features of a text are the words, word pairs and pairs with one word between them that
occur in it, hashed into a fixed number of coordinates. Training goes through a bounded sample
of labelled rows, with a learning rate for each coordinate and an L1 penalty that leaves most
coordinates at exactly zero. The others, at most `DIMENSIONS`, are broadcast as pairs of coordinate
and weight; every whole text of the table is scored where it lies, without a shuffle.

The sample is the `TRAINING_ROWS` labelled identifiers with the smallest hash, identifiers held out
(crc32 of the identifier as text modulo 5 is 0) excluded, with one row each: of rows that share an
identifier, the one with the smallest hash of its text. Their features lie in a
file of the one training task, which reads it once an epoch, so its memory does not grow with the
length of the texts. Labels are the only
thing learnt from; identifier, language and source are no features.

Defined cases: a null or empty text has no features, its score is that of the bias alone; a
null identifier counts as empty text in the hold-out rule and has no label; repeated labels of
a row count as toxic if one of them is; rows with null labels are not learnt from; without any
labelled row every score is 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import sole_cache, utf8, worker_cache

DIMENSIONS = 1 << 20
TRAINING_ROWS = 16_384
EPOCHS = 6
ALPHA, BETA, L1, L2 = 2.0, 1.0, 8.0, 0.0
FOLDS = 5
_CACHE_WORDS = 100_000
# Lower case for A-Z, a blank for any other ASCII character that is no letter or digit.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 7)
        return value


_hashes = worker_cache(_WordHashes())


def features(text: bytes) -> np.ndarray:
    """Hashed coordinates of a whole text, repeats included."""
    words = text.translate(_LETTERS).split()
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    odd, even = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    pairs = (h[:-1] * odd + h[1:]) * even
    skips = (h[:-2] * even + h[2:]) * odd
    return (np.concatenate((h, pairs, skips)) >> np.uint64(44)).astype(np.int64) % DIMENSIONS


def train_ftrl(rows: list[tuple[int, np.ndarray]], epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias after `epochs` passes over (label, distinct coordinates)."""
    z, n = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    bias_z = bias_n = 0.0

    def bias() -> float:
        return -bias_z * ALPHA / (BETA + np.sqrt(bias_n))

    def weights(at) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - L1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(epochs):
        for label, at in rows:
            w, b = weights(at), bias()
            gradient = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + b, -35, 35))) - label
            step = (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - step * w
            n[at] += gradient**2
            bias_z += gradient - (np.sqrt(bias_n + gradient**2) - np.sqrt(bias_n)) / ALPHA * b
            bias_n += gradient**2
    return weights(slice(None)), float(bias())


def held_out(id_col: str = "doc_id", folds: int = FOLDS) -> Column:
    text = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % folds) == 0


def _training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, limit: int) -> DataFrame:
    """Rows (order, label, coordinates) of the bounded sample; features are hashed where the texts lie."""
    ids = docs.select(F.col(f"`{id_col}`").alias("learn_id")).where("learn_id IS NOT NULL").distinct()
    sample = (
        labels.select(F.col("doc_id").alias("learn_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
        .where("learn_id IS NOT NULL AND label IS NOT NULL").where(~held_out("learn_id"))
        .groupBy("learn_id").agg(F.max("label").alias("label"))
        .join(ids, "learn_id", "left_semi")
        .withColumn("order", F.xxhash64("learn_id"))
        .orderBy("order", "learn_id").limit(limit)
    )
    # The limit bounds what is broadcast: `limit` rows of a few numbers.
    texts = docs.select(F.col(f"`{id_col}`").alias("text_id"), utf8(text_col).alias("body"), F.xxhash64(utf8(text_col)).alias("tie"))
    of_sample = texts.join(F.broadcast(sample), F.col("text_id") == F.col("learn_id"))
    one_each = of_sample.groupBy("learn_id", "order", "label").agg(F.min("tie").alias("one")).withColumnRenamed("learn_id", "one_id")
    joined = texts.join(F.broadcast(one_each), (F.col("text_id") == F.col("one_id")) & (F.col("tie") == F.col("one")))
    joined = joined.select("order", "label", "body").dropDuplicates(["order"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sole_cache(_hashes)
        for batch in batches:
            lists = [np.unique(features(t.as_py())).astype(np.int32) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int32()))], names=["order", "label", "at"]
            )

    return joined.mapInArrow(run, "order long, label int, at array<int>")


def _stored(batches: Iterator[pa.RecordBatch], spill: BinaryIO) -> list[tuple[int, np.ndarray]]:
    """All rows (label, coordinates) of (order, label, at); the coordinates lie in the file `spill`."""
    ends, labels, held = [0], [], 0
    for batch in batches:
        for label, at in zip(batch.column(1).to_pylist(), batch.column(2)):
            spill.write(at.values.to_numpy().astype(np.int32).tobytes())
            held += len(at)
            labels.append(label)
            ends.append(held)
    spill.flush()
    mapped = np.memmap(spill, np.int32, "r") if held else np.zeros(0, np.int32)
    return [(label, mapped[a:b]) for label, a, b in zip(labels, ends, ends[1:])]


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", limit: int = TRAINING_ROWS) -> pd.DataFrame:
    """Non-zero weights as (feature, weight); feature -1 is the bias.

    The sample of at most `limit` rows goes through one task, row by row in hash order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryFile() as spill:
            rows = _stored(batches, spill)
            if rows:
                weights, bias = train_ftrl(rows)
                used = np.flatnonzero(weights)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(used, -1)), pa.array(np.append(weights[used], bias))], names=["feature", "weight"]
                )

    rows = _training_rows(docs, labels, id_col, text_col, label_col, limit)
    one = rows.repartition(1).sortWithinPartitions("order", F.xxhash64("at"))
    return one.mapInArrow(run, "feature long, weight double").toPandas()


def toxicity_score(docs: DataFrame, model: pd.DataFrame, text_col: str = "text") -> Column:
    """Column of scores between 0 and 1 for the whole texts of `docs`."""
    inner = model[model["feature"] >= 0]
    bias = float(model.loc[model["feature"] == -1, "weight"].sum()) if len(model) else -np.inf
    shared = docs.sparkSession.sparkContext.broadcast((inner["feature"].to_numpy(np.int64), inner["weight"].to_numpy()))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        sole_cache(_hashes)
        w = np.zeros(DIMENSIONS)
        used, values = shared.value
        w[used] = values
        sums = np.empty(len(texts))
        for i, text in enumerate(texts):
            at = features(text)
            sums[i] = w[np.unique(at[w[at] != 0])].sum()
        return pd.Series(1.0 / (1.0 + np.exp(-np.clip(sums + bias, -700, 700))) if np.isfinite(bias) else np.zeros(len(texts)))

    return score(utf8(text_col))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", limit: int = TRAINING_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = train_toxicity(docs, labels, id_col, text_col, label_col, limit)
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), held_out(id_col).alias("held_out"),
        toxicity_score(docs, model, text_col).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
