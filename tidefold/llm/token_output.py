"""Token-id files: one compressed frame a document, a shared dictionary, an offset index.

A shard file, all numbers little-endian:

    magic        8 bytes  `TFTOKEN1`
    frames       a zstandard frame a document: its ids as unsigned 16-bit numbers, or 32-bit
                 ones for vocabularies beyond 65,536
    index        a record a document: has_id u1, doc_id i8, n_tokens u8, offset u8, length u8
    footer       index offset u8, documents u8, id width u4, sha256 of the dictionary, magic

The dictionary is trained once, on serialised id arrays of a bounded sample, and lies beside
the shards; every footer names it by its hash. A document is read by its index record and one
frame, so short documents need neither their neighbours nor a dictionary of their own.

Documents are dealt by ranges of their identifier and sorted, so shards in name order hold them
in ascending order. A shard is closed at `SHARD_BYTES`.

Defined cases: a null text counts as empty and is one end token; null identifiers come first;
rows that repeat an identifier are kept one by one, in the order of their texts; an empty table
gives no shard and no rows; with too little text for a dictionary, frames are compressed without
one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidefold.llm.common import materialise
from tidefold.llm.files import ShardWriter, locate
from tidefold.llm.tokens import encoder
from tidefold.session import broadcast_if_bounded, scratch_path

MAGIC = b"TFTOKEN1"
SHARD_BYTES = 64 * 1024 * 1024
DICTIONARY_BYTES = 64 * 1024
DICTIONARY_DOCS = 2048
DICTIONARY_DOC_CHARS = 8192
_INDEX = np.dtype([("has_id", "u1"), ("doc_id", "<i8"), ("n_tokens", "<u8"), ("offset", "<u8"), ("length", "<u8")])
_FOOTER = struct.Struct("<QQI32s8s")


def _bodies(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("body"))


def _serialised(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def train_dictionary(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                     sample_docs: int = DICTIONARY_DOCS, doc_chars: int = DICTIONARY_DOC_CHARS) -> bytes:
    """Dictionary from the `sample_docs` short documents with the smallest hash; empty if they are too few.

    The greatest of these hashes is found first, so that only hashes meet in one task and not
    the texts of every task's candidates. Rows that repeat identifier and text share a hash; the
    second limit keeps even these from growing the sample beyond twice its size.
    """
    short = _bodies(docs, id_col, text_col).where(F.length("body") <= doc_chars).withColumn("rank", F.xxhash64("doc_id", "body"))
    bound = short.select("rank").orderBy("rank").limit(sample_docs).agg(F.max("rank")).first()[0]
    if bound is None:
        return b""
    sample = short.where(F.col("rank") <= bound).limit(2 * sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer_path)
        width = 2 if tokens.tokenizer.get_vocab_size() <= 1 << 16 else 4
        for batch in batches:
            arrays = [_serialised(tokens.encode(t.as_py()), width) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array(arrays, pa.binary())], names=["ids"])

    samples = [bytes(row.ids) for row in sample.mapInArrow(run, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


class _Shard:
    """A shard in writing: frames go out at once, the index is kept."""

    def __init__(self, folder: str, name: str, width: int, dictionary: bytes):
        self.name, self.width, self.dictionary = name, width, dictionary
        self.out = ShardWriter(folder, name)
        self.out.write(MAGIC)
        self.index: list[tuple] = []
        self.n_tokens = 0

    def add(self, doc_id: int | None, n_tokens: int, frame: bytes) -> None:
        self.index.append((doc_id is not None, doc_id or 0, n_tokens, self.out.n_bytes, len(frame)))
        self.out.write(frame)
        self.n_tokens += n_tokens

    def close(self) -> tuple:
        at = self.out.n_bytes
        self.out.write(np.array(self.index, _INDEX).tobytes())
        self.out.write(_FOOTER.pack(at, len(self.index), self.width, hashlib.sha256(self.dictionary).digest(), MAGIC))
        self.out.close()
        return self.name, len(self.index), self.n_tokens


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=3, dict_data=data)


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, dictionary: bytes,
                 id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write all documents; the manifest, a row per shard: name, n_docs, n_tokens."""
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, compressor = encoder(tokenizer_path), _compressor(dictionary)
        width = 2 if max(tokens.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        partition, shard, done = TaskContext.get().partitionId(), None, []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if shard is None:
                    shard = _Shard(folder, f"shard-{partition:06d}-{len(done):05d}.tok", width, dictionary)
                ids = tokens.encode(text.as_py()) + end
                shard.add(doc_id, len(ids) // 4, compressor.compress(_serialised(ids, width)))
                if shard.out.n_bytes >= shard_bytes:
                    done.append(shard.close())
                    shard = None
        if shard is not None:
            done.append(shard.close())
        names, n_docs, n_tokens = zip(*done) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(n_docs, pa.int64()), pa.array(n_tokens, pa.int64())],
            names=["name", "n_docs", "n_tokens"],
        )

    ordered = _bodies(docs, id_col, text_col).repartitionByRange(F.col("doc_id")).sortWithinPartitions("doc_id", "body")
    return materialise(ordered.mapInArrow(run, "name string, n_docs long, n_tokens long"), "token-manifest")


def shard_index(content: bytes, dictionary: bytes) -> tuple[np.ndarray, int]:
    """Index and id width of a shard; an error if it is no shard or names another dictionary."""
    at, n_docs, width, digest, magic = _FOOTER.unpack_from(content, len(content) - _FOOTER.size)
    if magic != MAGIC or content[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token shard")
    if digest != hashlib.sha256(dictionary).digest():
        raise ValueError("the shard was written with another dictionary")
    return np.frombuffer(content, _INDEX, n_docs, at), width


def read_shards(spark: SparkSession, folder: str, dictionary: bytes) -> DataFrame:
    """A row per document as the files hold it: name, doc_id, start (in the shard), n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        frames = zstandard.ZstdDecompressor(dict_data=data)
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                content = content.as_py()
                index, width = shard_index(content, dictionary)
                counts, sums = [], []
                for record in index:
                    ids = frames.decompress(content[record["offset"]: record["offset"] + record["length"]])
                    wide = np.frombuffer(ids, f"<u{width}").astype("<u4")
                    counts.append(len(wide))
                    sums.append(zlib.crc32(wide.tobytes()))
                n_tokens = np.array(counts, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path.rsplit("/", 1)[1]] * len(index)),
                        pa.array(index["doc_id"], pa.int64(), mask=index["has_id"] == 0),
                        pa.array(np.cumsum(n_tokens) - n_tokens), pa.array(n_tokens), pa.array(sums, pa.int64()),
                    ],
                    names=["name", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder).select("path", "content")
    return files.mapInArrow(run, "name string, doc_id long, start long, n_tokens long, ids_crc32 long")


def read_document(folder: str, name: str, doc_id: int, dictionary: bytes) -> np.ndarray:
    """Ids of one document, from the index and its frame alone."""
    system, base = locate(folder)
    with system.open_input_file(f"{base}/{name}") as source:
        size = source.size()
        at, n_docs, width, _, _ = _FOOTER.unpack(source.read_at(_FOOTER.size, size - _FOOTER.size))
        index = np.frombuffer(source.read_at(n_docs * _INDEX.itemsize, at), _INDEX)
        record = index[(index["doc_id"] == doc_id) & (index["has_id"] == 1)][0]
        frame = source.read_at(int(record["length"]), int(record["offset"]))
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return np.frombuffer(zstandard.ZstdDecompressor(dict_data=data).decompress(frame), f"<u{width}").astype("<u4")


def token_output(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 folder: str | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the files and read them back: doc_id, start (over all shards), n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-shards")
    dictionary = train_dictionary(docs, tokenizer_path, id_col, text_col)
    if dictionary:
        writer = ShardWriter(folder, "dictionary.zdict")
        writer.write(dictionary)
        writer.close()
    manifest = write_shards(docs, folder, tokenizer_path, end_id, dictionary, id_col, text_col, shard_bytes)
    if manifest.isEmpty():
        return manifest.selectExpr("n_docs AS doc_id", "n_docs AS start", "n_tokens", "n_tokens AS ids_crc32")
    # A row per shard: its place follows from the totals of the shards before it.
    before = F.sum("n_tokens").over(W.orderBy("name").rowsBetween(W.unboundedPreceding, -1))
    starts = materialise(manifest.select("name", F.coalesce(before, F.lit(0)).alias("shard_start")), "token-starts")
    return (
        read_shards(spark, folder, dictionary).join(broadcast_if_bounded(starts), "name")
        .select("doc_id", (F.col("start") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32")
    )
