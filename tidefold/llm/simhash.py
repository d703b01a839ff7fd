"""SimHash near-deduplication by multi-index hashing.

A 64-bit fingerprint is the bitwise majority over the hashes of all word shingles. It is cut
into two segments of 32 bits. Two fingerprints that differ in at most `radius` bits differ in
at most `radius // 2` bits of one segment, so each fingerprint asks the table of a segment for
every value in the small Hamming ball around its own. Table entries are fetched by an
equi-join and the complete distance is verified.

Equal fingerprints are one entry, whatever the number of documents. A table value that many
different fingerprints share is kept as several chunks of bounded size, each a row of its own.
A task reduces the links it finds to a spanning forest, so no group gives all its pairs.

Defined cases: a null text counts as empty; a text without words has fingerprint zero and links
like any other; fewer words than a shingle make one shingle; a null identifier is never the
smallest unless all are null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import materialise, utf8
from tidefold.llm.components import connected_components, spanning_links

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
SEGMENT_BITS = 32
CHUNK_ENTRIES = 256
_COUNT_BLOCK = 1 << 16


def text_fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Fingerprint of one whole text, as an unsigned number."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    size = min(shingle_words, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1].tolist()
    ends = ends[size - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for block in range(0, len(starts), _COUNT_BLOCK):
        hashes = np.array(
            [digest(joined[a:b], seed) for a, b in zip(starts[block:block + _COUNT_BLOCK], ends[block:block + _COUNT_BLOCK])],
            "<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Rows (doc_id, fp): the fingerprint of every whole text as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([text_fingerprint(t.as_py(), shingle_words) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), utf8(text_col).alias("body")
    ).mapInArrow(run, "doc_id long, fp long")


def _segments(fp: Column) -> list[Column]:
    low_bits = (1 << SEGMENT_BITS) - 1
    return [fp.bitwiseAND(F.lit(low_bits)), F.shiftrightunsigned(fp, SEGMENT_BITS)]


def links(fps: DataFrame, radius: int = RADIUS, chunk_entries: int = CHUNK_ENTRIES) -> DataFrame:
    """Links (u, v) that connect what fingerprints within `radius` bits connect; `fps(fp)` is distinct.

    Spark sizes exploded rows as if there were one for each fingerprint and might broadcast them, so both joins
    are sort-merge joins at any size.
    """
    if not 0 <= radius <= 3:
        raise ValueError("two segments with balls of one bit answer for distances up to 3")
    ball = [0] + ([1 << bit for bit in range(SEGMENT_BITS)] if radius >= 2 else [])
    fp = F.col("fp")
    entries = fps.select(
        "fp", F.explode(F.array(*[F.struct(F.lit(s).alias("segment"), v.alias("value")) for s, v in enumerate(_segments(fp))])).alias("e")
    ).select("fp", "e.segment", "e.value")
    sizes = entries.groupBy("segment", "value").agg(F.count("*").alias("n"), F.min("fp").alias("only"))
    sizes = materialise(sizes, "simhash-sizes")
    alone = sizes.where("n = 1").select("segment", "value", F.array("only").alias("fps"))
    shared = (
        entries.join(sizes.where("n > 1").hint("merge"), ["segment", "value"])
        .withColumn("chunk", F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / chunk_entries)))
        .groupBy("segment", "value", "chunk").agg(F.collect_list("fp").alias("fps"))
        .select("segment", "value", "fps")
    )
    tables = materialise(alone.union(shared), "simhash-tables")
    probes = fps.select(
        fp.alias("probe"),
        F.explode(F.array(*[
            F.struct(F.lit(s).alias("segment"), v.bitwiseXOR(F.lit(mask)).alias("value"))
            for s, v in enumerate(_segments(fp)) for mask in ball
        ])).alias("p"),
    ).select("probe", "p.segment", "p.value")
    found = (
        probes.join(tables.hint("merge"), ["segment", "value"])
        .select("probe", F.filter("fps", lambda f: (f != F.col("probe")) & (F.bit_count(f.bitwiseXOR(F.col("probe"))) <= radius)).alias("near"))
        .where(F.size("near") > 0)
    )
    return found.mapInArrow(spanning_links, "u long, v long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS,
                       chunk_entries: int = CHUNK_ENTRIES) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id (smallest doc_id reachable)."""
    marked = materialise(fingerprints(docs, id_col, text_col, shingle_words), "simhash-docs")
    nodes = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    found = connected_components(links(nodes.select("fp"), radius, chunk_entries))
    named = nodes.join(found, nodes["fp"] == found["node"], "left").select(
        "fp", "first_id", F.coalesce("label", "fp").alias("label")
    )
    named = materialise(named, "simhash-named")
    smallest = materialise(
        named.groupBy("label").agg(F.min("first_id").alias("component_id")), "simhash-components"
    )
    classes = materialise(named.join(smallest, "label").select("fp", "component_id"), "simhash-classes")
    return marked.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
