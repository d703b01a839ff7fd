"""Token counts from flat token files by a separator scan.

A stream of token ids lies in numbered files `<stream>-<number>.bin` of fixed-width
little-endian ids, without index or length; an end id follows every document, and a document may
run across files. Files are read in blocks. In each block one vectorised comparison finds the
end ids. Where a document began is stitched by a prefix scan over blocks: the ids and the ends
before a block, and the place of the last end before it, follow from one small row per block.

Defined cases: ids after the last end of a stream are one more document with `ended` false; a
document may be empty; an empty file or folder gives no rows. The writer counts a null text as
empty, keeps rows that repeat an identifier one by one, and ignores other columns; an id that is
wider than the files' ids is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidefold.llm.common import materialise
from tidefold.llm.files import ShardWriter
from tidefold.llm.tokens import encoder
from tidefold.session import scratch_path

BLOCK_IDS = 1 << 20
FILE_BYTES = 32 * 1024 * 1024
ID_BYTES = 2


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", id_bytes: int = ID_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one stream per input partition; a row per document: stream, ordinal, doc_id.

    The rows say which document is which in a stream; neither lengths nor places are kept.
    """
    end = end_id.to_bytes(id_bytes, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer_path)
        stream = f"stream-{TaskContext.get().partitionId():06d}"
        pending, files, ordinal = bytearray(), 0, 0

        def flush(size: int) -> None:
            nonlocal files
            writer = ShardWriter(folder, f"{stream}-{files:06d}.bin")
            writer.write(bytes(pending[:size]))
            writer.close()
            del pending[:size]
            files += 1

        for batch in batches:
            for text in batch.column(1):
                ids = np.frombuffer(tokens.encode(text.as_py()), "<u4")
                if int(ids.max(initial=0)) >> 8 * id_bytes:
                    raise ValueError(f"token id {ids.max()} does not fit into {id_bytes} bytes; write wider ids")
                pending += ids.astype(f"<u{id_bytes}").tobytes() + end
                while len(pending) >= file_bytes:
                    flush(file_bytes)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([stream] * n, pa.string()), pa.array(range(ordinal, ordinal + n), pa.int64()), batch.column(0)],
                names=["stream", "ordinal", "doc_id"],
            )
            ordinal += n
        if pending:
            flush(len(pending))

    bodies = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("body"))
    return materialise(bodies.mapInArrow(run, "stream string, ordinal long, doc_id long"), "token-streams")


def _blocks(spark: SparkSession, folder: str, end_id: int, id_bytes: int, block_ids: int) -> DataFrame:
    """A row per block: stream, file, block, n_ids and the places of its end ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                stream, _, number = path.rsplit("/", 1)[1].removesuffix(".bin").rpartition("-")
                ids = np.frombuffer(content.as_buffer(), f"<u{id_bytes}")
                for block, at in enumerate(range(0, len(ids), block_ids)):
                    part = ids[at:at + block_ids]
                    yield pa.RecordBatch.from_pydict(
                        {"stream": [stream], "file": [int(number)], "block": [block], "n_ids": [len(part)],
                         "ends": [np.flatnonzero(part == end_id)]},
                        schema=pa.schema([("stream", pa.string()), ("file", pa.int64()), ("block", pa.int64()),
                                          ("n_ids", pa.int64()), ("ends", pa.list_(pa.int64()))]),
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder).select("path", "content")
    return files.mapInArrow(run, "stream string, file long, block long, n_ids long, ends array<long>")


def scan_separators(spark: SparkSession, folder: str, end_id: int, id_bytes: int = ID_BYTES,
                    block_ids: int = BLOCK_IDS) -> DataFrame:
    """A row per document: stream, ordinal, start, n_tokens (without the end id), ended."""
    blocks = materialise(_blocks(spark, folder, end_id, id_bytes, block_ids), "token-blocks")
    order = W.partitionBy("stream").orderBy("file", "block")
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    # The prefix scan: a row per block, without the places inside it.
    scanned = blocks.select(
        "stream", "file", "block", "n_ids", F.size("ends").alias("n_ends"),
        F.try_element_at("ends", F.lit(-1)).alias("last_end"),
    )
    scanned = scanned.withColumn("base", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))
    scanned = scanned.withColumn("place", F.col("base") + F.col("last_end")).select(
        "stream", "file", "block", "base",
        F.coalesce(F.sum("n_ends").over(earlier), F.lit(0)).alias("first_ordinal"),
        F.coalesce(F.last("place", ignorenulls=True).over(earlier), F.lit(-1)).alias("carried"),
        F.lead("file").over(order).isNull().alias("is_last"),
        F.coalesce(F.last("place", ignorenulls=True).over(order), F.lit(-1)).alias("carried_out"),
        (F.col("base") + F.col("n_ids")).alias("stop"),
        (F.coalesce(F.sum("n_ends").over(earlier), F.lit(0)) + F.col("n_ends")).alias("next_ordinal"),
    )
    scanned = materialise(scanned, "token-scan")
    ended = (
        blocks.select("stream", "file", "block", "ends")
        .join(scanned.select("stream", "file", "block", "base", "first_ordinal", "carried"), ["stream", "file", "block"])
        .select("stream", "base", "first_ordinal", "carried", "ends", F.posexplode("ends").alias("i", "end"))
        .withColumn("before", F.when(F.col("i") == 0, F.col("carried")).otherwise(F.col("base") + F.get("ends", F.col("i") - 1)))
        .select(
            "stream", (F.col("first_ordinal") + F.col("i")).alias("ordinal"), (F.col("before") + 1).alias("start"),
            (F.col("base") + F.col("end") - F.col("before") - 1).alias("n_tokens"), F.lit(True).alias("ended"),
        )
    )
    open_end = scanned.where(F.col("is_last") & (F.col("carried_out") + 1 < F.col("stop"))).select(
        "stream", F.col("next_ordinal").alias("ordinal"), (F.col("carried_out") + 1).alias("start"),
        (F.col("stop") - F.col("carried_out") - 1).alias("n_tokens"), F.lit(False).alias("ended"),
    )
    return ended.union(open_end)


def token_counts(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 folder: str | None = None, id_bytes: int = ID_BYTES, file_bytes: int = FILE_BYTES,
                 block_ids: int = BLOCK_IDS) -> DataFrame:
    """Write the token files of all documents and count from them: doc_id, stream, ordinal, start, n_tokens."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    names = write_token_files(docs, folder, tokenizer_path, end_id, id_col, text_col, id_bytes, file_bytes)
    if names.isEmpty():
        return names.selectExpr("doc_id", "stream", "ordinal", "ordinal AS start", "ordinal AS n_tokens")
    found = materialise(scan_separators(spark, folder, end_id, id_bytes, block_ids), "token-counts")
    return names.join(found, ["stream", "ordinal"]).select("doc_id", "stream", "ordinal", "start", "n_tokens")
