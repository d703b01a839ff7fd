"""Hard-negative mining by a secondary sort.

Rows are packed into chunks of bounded size and every chunk is scored against every chunk of
anchors, as products of integer matrices. The first pass keeps what can be among an anchor's
positives. With them the window of scores of each positive is known, and the second pass keeps,
per chunk and window, the negatives that can still be among the first. Each kept pair has one
packed key: anchor, descending score, positives before negatives, identifier. The pairs are dealt
by anchor and sorted by that key within partitions, and one iterator reads them in order: a
positive opens its window, a negative goes to the open windows that reach it, and a window that
is full or left behind closes. Nothing of an anchor is gathered but its open windows.

Anchors go to the tasks as chunks joined by number: broadcast if they were measured to be small,
else shuffled, each chunk meeting all rows once.

Defined cases: rows with a null label, a null vector or a component that is null or not finite
take no part; a null identifier is no anchor and comes after all others at equal scores; rows
that share an identifier are rows of their own, anchors too; of vectors of unlike lengths the
shorter one counts as continued by zeros, an empty one scores 0; scores beyond 64 bits count as
the nearest number within; an anchor without positives or negatives gives no rows; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefold.llm.common import materialise
from tidefold.session import broadcast_if_bounded

POSITIVES = 5
NEGATIVES = 5
# A negative's score is at least LOW and at most HIGH hundredths of the positive's.
LOW, HIGH = 80, 100
SCALE = 256
# Components of a chunk of rows and of a chunk of anchors.
ROW_VALUES = 1 << 18
ANCHOR_VALUES = 1 << 16

_CHUNK = "dims int, ids array<long>, labels array<int>, rows array<long>, data binary, windows array<array<long>>"
_PAIR = "anchor long, key binary"
_KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("no_id", "u1"), ("id", ">u8"), ("row", ">u8")])
_SIGN = np.uint64(1 << 63)
_LONGS = np.iinfo(np.int64)


def _chunks(limit: int):
    """Pack rows (row, id, label, vector, windows) into chunks of at most `limit` components."""

    def close(rows: list[tuple]) -> dict:
        dims = max(len(r[3]) for r in rows)
        data = np.zeros((len(rows), dims))
        for at, (_, _, _, vector, _) in enumerate(rows):
            data[at, :len(vector)] = vector
        return {"dims": dims, "ids": [r[1] for r in rows], "labels": [r[2] for r in rows], "rows": [r[0] for r in rows],
                "data": data.tobytes(), "windows": [r[4] for r in rows]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("dims", pa.int32()), ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int32())), ("rows", pa.list_(pa.int64())),
            ("data", pa.binary()), ("windows", pa.list_(pa.list_(pa.int64()))),
        ])
        rows, dims = [], 0
        for batch in batches:
            flat, at = batch.column(3).flatten().to_numpy(zero_copy_only=False), 0
            lengths = np.diff(batch.column(3).offsets.to_numpy()).tolist()
            for row, id_, label, length, windows in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2)), lengths, batch.column(4).to_pylist()):
                if rows and (len(rows) + 1) * max(dims, length) > limit:
                    yield pa.RecordBatch.from_pylist([close(rows)], schema=schema)
                    rows, dims = [], 0
                rows.append((row, id_, label, flat[at:at + length], windows))
                dims, at = max(dims, length), at + length
        if rows:
            yield pa.RecordBatch.from_pylist([close(rows)], schema=schema)

    return run


def _whole(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) as Python numbers, exact for every finite x."""
    return np.array([[int(x // 1) * SCALE + int((x % 1) * SCALE // 1) for x in row] for row in values.tolist()], object).reshape(values.shape)


def inner_products(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of `one` with all of `two`, after floor(SCALE * x)."""
    dims = max(one.shape[1], two.shape[1])
    one, two = (np.pad(m, ((0, 0), (0, dims - m.shape[1]))) for m in (one, two))
    with np.errstate(over="ignore"):
        p, q = np.floor(one * SCALE), np.floor(two * SCALE)
    with np.errstate(over="ignore", invalid="ignore"):
        bound = np.abs(p).max(initial=0) * np.abs(q).max(initial=0) * dims
    if bound < 2.0**53:
        return (p @ q.T).astype(np.int64)
    exact = _whole(one) @ _whole(two).T
    return np.clip(exact, int(_LONGS.min), int(_LONGS.max)).astype(np.int64)


def first_places(scores: np.ndarray, allowed: np.ndarray, n: int) -> np.ndarray:
    """Places of the `n` greatest allowed scores; of equal ones the earlier places."""
    at = np.flatnonzero(allowed)
    if len(at) <= n:
        return at
    found = scores[at]
    least = np.partition(found, len(found) - n)[len(found) - n]
    above = at[found > least]
    return np.concatenate([above, at[found == least][:n - len(above)]])


def _matrix(chunk: dict) -> np.ndarray:
    return np.frombuffer(chunk["data"]).reshape(len(chunk["rows"]), chunk["dims"])


def least_score(positive_score: int, low: int = LOW, high: int = HIGH) -> int:
    """The least whole score s with low * positive_score <= high * s."""
    return -(-low * positive_score // high)


def _scored(kind: int, n: int, low: int, high: int):
    """Pairs that can be among the first `n`: same label (kind 0), or another within a window (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                rows, anchors = pair["chunk"], pair["anchors"]
                ids = np.array([0 if i is None else i for i in rows["ids"]], np.int64)
                no_id = np.array([i is None for i in rows["ids"]], bool)
                order = np.lexsort((ids, no_id))
                ids, no_id, numbers = ids[order], no_id[order], np.array(rows["rows"], np.int64)[order]
                labels = np.array(rows["labels"], np.int64)[order]
                scores = inner_products(_matrix(anchors), _matrix(rows)[order])
                found = []
                for at, (row, label, windows) in enumerate(zip(anchors["rows"], anchors["labels"], anchors["windows"])):
                    if kind == 0:
                        places = first_places(scores[at], (labels == label) & (numbers != row), n)
                    else:
                        other = labels != label
                        each = [
                            first_places(scores[at], other & (scores[at] <= top) & (scores[at] >= least_score(top, low, high)), n)
                            for top in windows
                        ]
                        places = np.unique(np.concatenate(each)) if each else np.zeros(0, np.int64)
                    keys = np.zeros(len(places), _KEY)
                    keys["anchor"] = row
                    keys["score"] = ~(scores[at][places].view(np.uint64) ^ _SIGN)
                    keys["kind"], keys["no_id"] = kind, no_id[places]
                    keys["id"] = ids[places].view(np.uint64) ^ _SIGN
                    keys["row"] = numbers[places]
                    found.append(keys)
                keys = np.concatenate(found).astype(_KEY)  # concatenation turns to native byte order
                data = [pa.py_buffer(np.arange(len(keys) + 1, dtype=np.int32) * _KEY.itemsize), pa.py_buffer(keys.tobytes())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys["anchor"].astype(np.int64)), pa.Array.from_buffers(pa.binary(), len(keys), [None, *data])],
                    names=["anchor", "key"],
                )

    return run


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of a batch, their scores and identifiers as signed numbers."""
    keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), _KEY)
    score = (~keys["score"].astype(np.uint64) ^ _SIGN).view(np.int64)
    return keys, score, (keys["id"].astype(np.uint64) ^ _SIGN).view(np.int64)


def _emit(negatives: int, low: int, high: int):
    """Read pairs in key order; positives open windows, negatives go to the open ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("anchor", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()),
            ("positive_score", pa.int64()), ("negative_score", pa.int64()),
        ])
        anchor, windows = None, []
        for batch in batches:
            keys, scores, ids = _unpacked(batch)
            out = []
            for of, score, kind, no_id, id_ in zip(
                keys["anchor"].tolist(), scores.tolist(), keys["kind"].tolist(), keys["no_id"].tolist(), ids.tolist()
            ):
                id_ = None if no_id else id_
                if of != anchor:
                    anchor, windows = of, []
                if kind == 0:
                    windows.append([id_, score, least_score(score, low, high), 0])
                    continue
                windows = [w for w in windows if w[2] <= score and w[3] < negatives]
                for window in windows:
                    if score <= window[1]:
                        window[3] += 1
                        out.append((of, window[0], window[3], id_, window[1], score))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip_longest(zip(*out), schema, fillvalue=())], schema=schema)

    return run


def hard_negatives(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
                   high: int = HIGH, row_values: int = ROW_VALUES, anchor_values: int = ANCHOR_VALUES) -> DataFrame:
    """For each anchor and each of its first positives, the first negatives of like score.

    Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score). `is_anchor`
    is taken on `vectors`; `low` and `high` bound a negative's score: low * positive_score <=
    high * score <= high * positive_score.
    """
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    entries = materialise(
        vectors.select(
            F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"),
            F.col(f"`{label_col}`").cast("int").alias("label"), vector.alias("vector"),
            F.coalesce(is_anchor & F.col(f"`{id_col}`").isNotNull(), F.lit(False)).alias("is_anchor"),
            F.coalesce(F.col(f"`{label_col}`").isNotNull() & F.col(f"`{vector_col}`").isNotNull() & fine, F.lit(False)).alias("fine"),
        ).where("fine").drop("fine"),
        "negatives-entries",
    )
    none = F.expr("CAST(array() AS array<bigint>)").alias("windows")
    chunks = materialise(
        entries.select("row", "id", "label", "vector", none).mapInArrow(_chunks(row_values), _CHUNK), "negatives-chunks"
    ).select(F.struct("*").alias("chunk"))
    anchors = entries.where("is_anchor").select("row", "id", "label", "vector")

    def pairs(of_anchors: DataFrame, kind: int, n: int) -> DataFrame:
        packed = materialise(
            of_anchors.mapInArrow(_chunks(anchor_values), _CHUNK).withColumn("block", F.monotonically_increasing_id()),
            "negatives-anchors",
        )
        blocks = materialise(packed.select("block"), "negatives-blocks")
        # Each chunk of rows goes to each chunk of anchors: the numbers of the latter are its keys.
        numbers = F.array(*[F.lit(r.block) for r in blocks.collect()]).cast("array<long>")
        dealt = chunks.select("chunk", F.explode(numbers).alias("block"))
        met = dealt.join(broadcast_if_bounded(packed.select("block", F.struct(*packed.columns[:-1]).alias("anchors"))), "block")
        return met.select("chunk", "anchors").mapInArrow(_scored(kind, n, low, high), _PAIR)

    first = Window.partitionBy("anchor").orderBy("key")
    found = pairs(anchors.withColumn("windows", none), 0, positives)
    found = materialise(
        found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives).drop("place"), "negatives-positives"
    )

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("anchor"), pa.array(_unpacked(batch)[1])], names=["row", "score"])

    windows = found.mapInArrow(scores, "row long, score long").groupBy("row").agg(F.collect_set("score").alias("windows"))
    candidates = pairs(anchors.join(windows, "row"), 1, negatives)
    in_order = found.union(materialise(candidates, "negatives-pairs")).repartition("anchor").sortWithinPartitions("key")
    mined = in_order.mapInArrow(
        _emit(negatives, low, high),
        "anchor long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
    )
    names = broadcast_if_bounded(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")))
    return mined.join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


HARD_NEGATIVES_SQL = """
WITH fine AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM fine a JOIN fine b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, n.vec_id AS negative_id, positive_score,
       n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score
WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER best <= 5
"""
