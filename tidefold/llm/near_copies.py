"""Near copies by SimHash and min-hash, verified by the exact Jaccard similarity of word shingles.

Candidates are fetched by op6's SimHash index: 64-bit fingerprints of the shingles, linked within 3
bits, and a key for each component. Of pairs that are just alike few lie so close (radius 15 or so
would be needed, where segments tell nothing apart), so min-hash bands fetch what the fingerprints
miss: `BANDS` keys of `ROWS` minima each, so a pair of similarity s shares a key with probability
1 - (1 - s ** ROWS) ** BANDS, 99.8% at 0.8. Every fetched pair that decides about a document is
verified on the whole texts, shingle by shingle.

The documents are taken in order of identifiers: one stays unless it is alike to a smaller one
that stays. So whatever goes has its likeness among what stays, and no chain of links removes
more. First, in rounds, every document that is the first under all its keys stays and is compared
with all that share a key with it: a group of copies costs its size and not its pairs. When
rounds remove little, what is left are groups that share keys though few in them are alike. Their
texts are not paired either: each gets a parity sketch, one bit for the parity of the shingles
that fall into a bin, with eight bins a shingle. Two sketches differ in no more bits than the
texts differ in shingles, so comparing sketches in chunks loses nothing, and with so many bins
hardly a pair passes that is not alike; only those that do are verified. The smallest texts of a
key are settled among themselves first. Those that stay are compared with the others, each of which
is paired with the nearest, and with further ones only if that one is not alike; what goes meets
nothing else. So the pairs do not grow with the square of a group of loose copies either.

Defined cases: a null text counts as empty, and texts without words are alike; fewer words than
a shingle make one shingle; a null identifier comes last; rows that share identifier and text
are one document; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefold.llm.common import materialise, sole_cache, utf8
from tidefold.llm.components import connected_components
from tidefold.llm.simhash import links, text_fingerprint

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 20
ROWS = 6
SEED = 42
# Bins of a sketch: a power of two, so many times the shingles; bytes of sketches in a chunk.
LEAST_BINS = 1 << 10
BINS_PER_SHINGLE = 8
CHUNK_BYTES = 1 << 18
# So many texts of a key, the smallest, are compared with all others at first.
FRONT = 128
_BLOCK = 1 << 10

_FACTORS, _SHIFTS = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * ROWS, 1), np.uint64)
_FACTORS |= np.uint64(1)
_BAND_SEEDS = np.arange(BANDS, dtype=np.uint64)[:, None]


def shingles(text: bytes, shingle_words: int = SHINGLE_WORDS) -> set[bytes]:
    """The distinct word shingles of one whole text."""
    words = text.lower().split()
    size = min(shingle_words, len(words))
    return {b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)} if words else {b""}


def jaccard(one: set[bytes], two: set[bytes]) -> float:
    shared = len(one & two)
    return shared / (len(one) + len(two) - shared)


def _hashes(text: bytes, shingle_words: int) -> np.ndarray:
    """A number for each distinct shingle."""
    return np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles(text, shingle_words)], np.uint64)


def sketch(text: bytes, shingle_words: int = SHINGLE_WORDS) -> tuple[np.ndarray, int]:
    """BANDS keys, and the number of distinct shingles; equal shingle sets have equal ones."""
    hashes = _hashes(text, shingle_words)
    minima = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _BLOCK):
        mixed = hashes[None, at:at + _BLOCK] * _FACTORS
        mixed += _SHIFTS
        np.minimum(minima, mixed.min(axis=1), out=minima)
    rows = np.concatenate([minima.reshape(BANDS, ROWS), _BAND_SEEDS], axis=1)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), SEED) for row in rows], np.uint64).view(np.int64), len(hashes)


def _node(doc_id: Column, tie: Column) -> Column:
    """A document, in the order in which documents are taken."""
    return F.struct(doc_id.isNull().alias("no_id"), F.coalesce(doc_id, F.lit(0)).alias("doc_id"), tie.alias("tie"))


def node_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Column:
    return _node(docs[f"`{id_col}`"].cast("long"), F.xxhash64(F.coalesce(docs[f"`{text_col}`"], F.lit(""))))


def _sketches(docs: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sole_cache()
        for batch in batches:
            bodies = [text.as_py() for text in batch.column(2)]
            found = [sketch(body, shingle_words)[0] for body in bodies]
            prints = np.array([text_fingerprint(body, shingle_words) for body in bodies], np.uint64).view(np.int64)
            keys = np.concatenate(found) if found else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype=np.int32) * BANDS, pa.array(keys))
            columns = [batch.column(0), batch.column(1), lists, pa.array(prints)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "tie", "keys", "fp"])

    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("tie"), utf8(text_col).alias("body"),
    ).mapInArrow(run, "doc_id long, tie long, keys array<long>, fp long")


def _alike(pairs: DataFrame, texts: DataFrame, similarity: float, shingle_words: int) -> DataFrame:
    """Those of `pairs(first, node)` whose texts are at least `similarity` alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, set()
        for batch in batches:
            keep = []
            for one, two in zip(batch.column(2), batch.column(3)):
                one = one.as_py()
                if one != last:
                    last, known = one, shingles(one, shingle_words)
                keep.append(jaccard(known, shingles(two.as_py(), shingle_words)) >= similarity)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    two = texts.select("node", F.col("body").alias("two"))
    one = texts.select(F.col("node").alias("first"), F.col("body").alias("one"))
    both = pairs.join(two, "node").join(one, "first").select("first", "node", "one", "two")
    node = both.schema["node"].dataType.simpleString()
    return both.mapInArrow(run, f"first {node}, node {node}")


def parity_sketch(text: bytes, shingle_words: int = SHINGLE_WORDS) -> tuple[int, bytes]:
    """Number of distinct shingles, and for each bin the parity of those in it."""
    hashes = _hashes(text, shingle_words)
    n_bins = max(LEAST_BINS, 1 << (BINS_PER_SHINGLE * len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(n_bins - 1)).astype(np.int64), minlength=n_bins) & 1
    return len(hashes), np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """The sketches with half as many bins where there are too many: bins add up as bits do by exclusive or."""
    return sketches if sketches.shape[1] == words else sketches[:, :words] ^ sketches[:, words:]


def _close(similarity: float, low: int = 0, high: int | None = None):
    """Pairs (one, two), one the smaller, of two chunks of a key whose sketches allow `similarity`.

    A pair is given under the first key that it shares and no other. `low` and `high` choose, for each text of the
    second chunk, from those of the first chunk in order of their distance.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                key = batch.column(0)[row].as_py()
                one, two = (batch.column(i)[row].values for i in (1, 2))
                words = min(len(m.field("bits")[0].as_py()) for m in (one, two)) // 8
                a, b = (np.frombuffer(b"".join(m.field("bits").to_pylist()), np.uint64).reshape(len(m), -1) for m in (one, two))
                a, b = _folded(a, words), _folded(b, words)
                a_size, b_size = (m.field("size").to_numpy(zero_copy_only=False).astype(np.int64) for m in (one, two))
                found: dict[int, list[tuple[float, int]]] = {}
                for at in range(len(a)):
                    share = np.bitwise_count(b ^ a[at]).sum(axis=1, dtype=np.int64) / (a_size[at] + b_size)
                    for other in np.flatnonzero(share <= (1 - similarity) / (1 + similarity) + 1e-12).tolist():
                        found.setdefault(other, []).append((share[other], at))
                if not found:
                    continue
                a_nodes, b_nodes = ([tuple(n.values()) for n in m.field("node").to_pylist()] for m in (one, two))
                a_keys, b_keys = ([frozenset(k) for k in m.field("keys").to_pylist()] for m in (one, two))
                chosen = []
                for other, near in found.items():
                    near = [n for n in sorted(near) if a_nodes[n[1]] < b_nodes[other] and min(a_keys[n[1]] & b_keys[other]) == key]
                    chosen += [(at, other) for _, at in near[low:high]]
                if chosen:
                    places = [pa.array(side, pa.int64()) for side in zip(*chosen)]
                    nodes = [m.field("node").take(p) for m, p in zip((one, two), places)]
                    yield pa.RecordBatch.from_arrays(nodes, names=["one", "two"])

    return run


def sketched(active: DataFrame, texts: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Rows (key, node, size, bits, keys, bytes): the parity sketch of each text and all its keys, under each of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parity_sketch(text.as_py(), shingle_words) for text in batch.column(1)]
            sizes, bits = pa.array([n for n, _ in found], pa.int64()), pa.array([b for _, b in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, bits], names=["node", "size", "bits"])

    node = texts.schema["node"].dataType.simpleString()
    sketches = materialise(texts.select("node", "body").mapInArrow(run, f"node {node}, size long, bits binary"), "near-parities")
    sketches = sketches.join(active.groupBy("node").agg(F.collect_set("key").alias("keys")), "node")
    return materialise(active.select("key", "node").join(sketches, "node").withColumn("bytes", F.octet_length("bits")), "near-entries")


def sketched_pairs(active: DataFrame, texts: DataFrame, similarity: float, shingle_words: int,
                   chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Pairs (first, node) of `active(key, node)` that share a key and whose sketches allow `similarity`.

    `texts(node, body)` has the texts. No pair that is alike gets lost.
    """
    return front_pairs(sketched(active, texts, shingle_words), active.select("node").distinct(), similarity, chunk_bytes)


def front_pairs(entries: DataFrame, front: DataFrame, similarity: float, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Pairs (first, node), the smaller one of `front(node)`, that share a key and whose sketches allow `similarity`.

    `entries` are those of `sketched`. No pair that is alike gets lost.
    """
    one = _chunks(entries.join(front, "node", "left_semi"), "a", chunk_bytes)
    return _met(one, _chunks(entries, "b", chunk_bytes), similarity)


def _chunks(entries: DataFrame, side: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    counts = entries.groupBy("key", "bytes").agg(F.ceil(F.sum("bytes") / chunk_bytes).alias("n_chunks"))
    chunked = entries.join(counts, ["key", "bytes"]).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("n_chunks")))
    members = F.collect_list(F.struct("node", "size", "bits", "keys")).alias(f"{side}_members")
    return materialise(chunked.groupBy("key", F.col("bytes").alias(f"{side}_bytes"), "chunk").agg(members).drop("chunk"), "near-chunks")


def _met(one: DataFrame, two: DataFrame, similarity: float, low: int = 0, high: int | None = None) -> DataFrame:
    """Pairs (first, node) of chunks of the same key; `low` and `high` as in `_close`."""
    # Texts that are alike have as many bins, or one twice those of the other.
    a, b = F.col("a_bytes"), F.col("b_bytes")
    met = one.join(two, "key").where((a == b) | (2 * a == b) | (a == 2 * b)).select("key", "a_members", "b_members")
    node = one.schema["a_members"].dataType.elementType["node"].dataType.simpleString()
    pairs = met.mapInArrow(_close(similarity, low, high), f"one {node}, two {node}")
    return pairs.select(F.col("one").alias("first"), F.col("two").alias("node")).distinct()


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS,
                similarity: float = SIMILARITY) -> DataFrame:
    """Rows (node): the documents, as `node_of` names them, that go."""
    sketches = materialise(_sketches(docs, id_col, text_col, shingle_words), "near-sketches")
    components = connected_components(links(materialise(sketches.select("fp").distinct(), "near-prints")))
    named = sketches.select("doc_id", "tie", "fp").join(components.withColumnRenamed("node", "fp"), "fp", "left")
    by_print = named.select("doc_id", "tie", F.xxhash64(F.lit("simhash"), F.coalesce("label", "fp")).alias("key"))
    entries = materialise(sketches.select("doc_id", "tie", F.explode("keys").alias("key")).union(by_print), "near-entries")
    mark = F.xxhash64("doc_id", "tie")
    shared = materialise(
        entries.select("key", mark.alias("mark")).groupBy("key").agg(F.min("mark").alias("a"), F.max("mark").alias("b"))
        .where("a != b").select("key"), "near-keys",
    )
    active = materialise(
        entries.join(shared, "key", "left_semi").select("key", _node(F.col("doc_id"), F.col("tie")).alias("node")).distinct(),
        "near-active",
    )
    nodes = materialise(active.select("node").distinct(), "near-nodes")
    bodies = docs.select(node_of(docs, id_col, text_col).alias("node"), utf8(text_col).alias("body"))
    texts = materialise(bodies.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("body").alias("body")), "near-texts")
    gone = materialise(nodes.where("false"), "near-gone")
    while True:
        firsts = active.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"))
        firsts = materialise(firsts.where("first != last").select("key", "first"), "near-firsts")
        active = materialise(active.join(firsts, "key"), "near-active")
        settled = active.groupBy("node").agg(F.min(F.col("node") == F.col("first")).alias("settled"))
        settled = materialise(settled, "near-settled")
        left = settled.count()
        if not left:
            return gone
        heads = settled.where("settled").select("node")
        pairs = active.where("node != first").join(heads.withColumnRenamed("node", "first"), "first", "left_semi")
        pairs = materialise(pairs.select("first", "node").distinct(), "near-pairs")
        alike = materialise(_alike(pairs, texts, similarity, shingle_words).select("node").distinct(), "near-gone")
        gone = gone.union(alike)
        done = materialise(heads.union(alike), "near-done")
        active = materialise(active.select("key", "node").join(done, "node", "left_anti"), "near-active")
        if alike.count() * 20 < left:
            break
    return gone.union(_fronts(active, texts, similarity, shingle_words))


def _fronts(active: DataFrame, texts: DataFrame, similarity: float, shingle_words: int) -> DataFrame:
    """Rows (node) that go among `active(key, node)`: what stays of the first `FRONT` texts of every key at a time meets all that share a key.

    The front is settled by its own pairs. Of those that stay, each other text meets the nearest at first, so a text gives
    a pair or a few and not one for each text of the front that it is alike to. A front is widened while it removes less than it holds, so few rounds are needed, and what is verified
    grows with what goes and not with the pairs of a group.
    """
    rest = texts.join(active.select("node").distinct(), "node", "left_semi")
    entries = sketched(active, rest, shingle_words)
    gone, size = materialise(active.select("node").where("false"), "near-gone"), FRONT
    while not entries.isEmpty():
        # A node is in front if it is so under all its keys, and known if all smaller ones it shares a key with are in front.
        place = F.row_number().over(Window.partitionBy("key").orderBy("node"))
        placed = entries.select("key", "node", (place <= size).alias("early"))
        front = materialise(placed.groupBy("node").agg(F.min("early").alias("front")), "near-front")
        marked = materialise(entries.select("key", "node").join(front, "node"), "near-marked")
        bounds = marked.where("NOT front").groupBy("key").agg(F.min("node").alias("bound"))
        known = marked.where("front").join(bounds, "key", "left").groupBy("node").agg(
            F.min(F.coalesce(F.col("node") < F.col("bound"), F.lit(True))).alias("known")
        )
        known = materialise(known.where("known").select("node"), "near-known")
        ahead = front.where("front").select("node")
        among = entries.join(ahead, "node", "left_semi")
        pairs = materialise(front_pairs(among, ahead, similarity), "near-pairs")
        edges = materialise(_alike(pairs, rest, similarity, shingle_words), "near-edges")
        done = materialise(known.where("false"), "near-gone")
        while True:
            heads = edges.select("first").distinct().join(edges.select(F.col("node").alias("first")).distinct(), "first", "left_anti")
            heads = heads.join(known.withColumnRenamed("node", "first"), "first", "left_semi")
            out = materialise(edges.join(heads, "first", "left_semi").select("node").distinct(), "near-gone")
            if out.isEmpty():
                break
            done = done.union(out)
            edges = materialise(
                edges.join(out, "node", "left_anti").join(out.withColumnRenamed("node", "first"), "first", "left_anti"), "near-edges"
            )
        stays = known.join(edges.select("node").distinct(), "node", "left_anti").join(done, "node", "left_anti")
        stays = materialise(stays, "near-stays")
        # The others meet those that stay, the nearest one first and the rest only if that is not alike.
        ones = entries.join(stays, "node", "left_semi")
        later = entries.join(ahead, "node", "left_anti").join(ones.select("key").distinct(), "key", "left_semi")
        one = _chunks(ones, "a")
        for low, high in ((0, 1), (1, None)):
            pairs = materialise(_met(one, _chunks(later, "b"), similarity, low, high), "near-pairs")
            out = materialise(_alike(pairs, rest, similarity, shingle_words).select("node").distinct(), "near-gone")
            done = done.union(out)
            tried = materialise(pairs.select("node").distinct().join(out, "node", "left_anti"), "near-tried")
            later = later.join(tried, "node", "left_semi")
        gone = gone.union(done)
        settled = materialise(stays.union(done), "near-done")
        if done.count() < known.count():
            size *= 8
        entries = materialise(entries.join(settled, "node", "left_anti"), "near-entries")
    return gone
