"""Benchmark decontamination by a prefix-filtered join.

A benchmark item is a set of windows of consecutive words; a window occurs in a document only if
all its shingles do, so it is enough to look at one of them: its rarest. In a first pass every
document counts the shingles of the windows; windows with a shingle that never occurs are done
with, and each other one is indexed under its rarest shingle alone. In a second pass documents
look up their shingles among those. A hit at some place gives the place where the window would
have to begin (positional bound), which must lie in the document with all its words (length
bound), and there its words are compared one by one. What occurs marks the words it covers.

The index is a dictionary of the windows' words and sorted arrays, so a document costs one
lookup a word and one a shingle, and it stays where it is: nothing of it is shuffled. The
windows go out in blocks of bounded size, each against all documents; however large the
benchmark, a task holds one block. Hits are reported by digest of the text, with the runs of
covered words, and results of several blocks are united. Items are named by classes: windows
that the same items have in common share one, so a passage of many windows is one entry a
document.

Defined cases: a null text has no words; an item without words has no windows, one with fewer
than the window's length is one window; a null item identifier counts as an item, named ''; rows
that share an item identifier are one item; repeated documents are rows of their own; an empty
benchmark leaves all documents clean; an empty table of documents gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.llm.common import materialise, utf8
from tidefold.session import broadcast_if_bounded

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
BLOCK_WINDOWS = 100_000
# Three words of a block are packed into one number.
_WORD_BITS = 21
_PAIRS_AT_ONCE = 1 << 16

# Letters and digits of words, A-Z already in lower case; every byte beyond ASCII belongs to one.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
# Longer words are told apart by digest, so that a window has a bounded size.
_LONGEST_WORD = 64


def words_of(text: bytes) -> list[bytes]:
    """The words of one whole text, long ones as digests."""
    words = text.translate(_LETTERS).split()
    if words and max(map(len, words)) > _LONGEST_WORD:
        words = [w if len(w) <= _LONGEST_WORD else b"#" + hashlib.sha256(w).hexdigest().encode()[:-1] for w in words]
    return words


@dataclass
class Index:
    """One block of windows: ids of their words, and where to look for them.

    `words` numbers words from 1; `windows` holds word numbers, 0 beyond a window's length;
    `shingles` are all packed shingles, sorted, each of the size in `sizes`. Once rarities are
    known, `keys` are the packed shingles under which windows are indexed, by size, with
    `of_key[starts[k]:starts[k + 1]]` as the windows of a key and `offset` as their place in each.
    """

    words: dict[bytes, int]
    windows: np.ndarray
    lengths: np.ndarray
    classes: list[str]
    shingles: dict[int, np.ndarray]
    keys: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] | None = None


def _packed(ids: np.ndarray, size: int) -> np.ndarray:
    """Each run of `size` word numbers as one number; 0 where one of them is unknown."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    packed, known = np.zeros(n, np.int64), np.ones(n, bool)
    for at in range(size):
        part = ids[at:at + n]
        packed = (packed << _WORD_BITS) | part
        known &= part > 0
    return np.where(known, packed, 0)


def _by_size(index: Index, shingle_words: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each size of shingle, the windows that are cut into such: short windows are one shingle."""
    sizes = np.minimum(index.lengths, shingle_words)
    for size in np.unique(sizes).tolist():
        yield size, np.flatnonzero(sizes == size)


def build_index(rows: list[tuple[bytes, str]], window_words: int, shingle_words: int) -> Index:
    """Index of windows (words joined by blanks, class); rarities still unknown."""
    numbers: dict[bytes, int] = {}
    windows, lengths = np.zeros((len(rows), window_words), np.int64), np.zeros(len(rows), np.int64)
    for at, (window, _) in enumerate(rows):
        words = window.split(b" ")
        lengths[at] = len(words)
        windows[at, :len(words)] = [numbers.setdefault(w, len(numbers) + 1) for w in words]
    if len(numbers) >> _WORD_BITS:
        raise ValueError(f"{len(numbers)} words in a block of windows; take smaller blocks")
    index = Index(numbers, windows, lengths, [c for _, c in rows], {})
    for size, of in _by_size(index, shingle_words):
        index.shingles[size] = np.unique(np.concatenate([_packed(row, size) for row in windows[of]]))
        index.shingles[size] = index.shingles[size][index.shingles[size] > 0]
    return index


def choose_keys(index: Index, counts: dict[int, np.ndarray], shingle_words: int) -> None:
    """Index every window under its rarest shingle; a window with one that never occurs is left out."""
    index.keys = {}
    for size, of in _by_size(index, shingle_words):
        known, n = index.shingles[size], counts.get(size, np.zeros(0, np.int64))
        n = n if len(n) else np.zeros(len(known), np.int64)
        best, chosen, offsets = np.zeros(len(of), np.int64), np.zeros(len(of), np.int64), np.zeros(len(of), np.int64)
        for offset in range(index.windows.shape[1] - size + 1):
            inside = index.lengths[of] >= offset + size
            packed = np.zeros(len(of), np.int64)
            for at in range(size):
                packed = (packed << _WORD_BITS) | index.windows[of, offset + at]
            rarity = n[np.minimum(np.searchsorted(known, packed), len(known) - 1)]
            better = inside & ((rarity < best) | (offset == 0))
            best, chosen, offsets = (np.where(better, new, old) for new, old in ((rarity, best), (packed, chosen), (offset, offsets)))
        there = best > 0
        order = np.argsort(chosen[there], kind="stable")
        keys, starts = np.unique(chosen[there][order], return_index=True)
        index.keys[size] = (keys, np.append(starts, there.sum()), of[there][order], offsets[there][order])


def _lookup(keys: np.ndarray, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in `packed` that hold one of the sorted `keys`, and which."""
    places = np.flatnonzero(packed)
    if not len(keys) or not len(places):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = np.searchsorted(keys, packed[places])
    right = keys[np.minimum(found, len(keys) - 1)] == packed[places]
    return places[right], found[right]


def _numbered(index: Index, words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(index.words.get, words, repeat(0)), np.int64, len(words))


def count_shingles(index: Index, words: list[bytes], counts: dict[int, np.ndarray]) -> None:
    """Add the occurrences of the index's shingles in one document to `counts`."""
    ids = _numbered(index, words)
    if ids.any():
        for size, known in index.shingles.items():
            counts[size] += np.bincount(_lookup(known, _packed(ids, size))[1], minlength=len(known))


def occurrences(index: Index, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and numbers of the windows that occur in one document, in bounded portions."""
    ids = _numbered(index, words)
    if not ids.any():
        return
    span = np.arange(index.windows.shape[1])
    ids_on = np.concatenate([ids, np.zeros(len(span), np.int64)])
    for size, (keys, starts, windows, offsets) in index.keys.items():
        places, found = _lookup(keys, _packed(ids, size))
        n = starts[found + 1] - starts[found] if len(found) else np.zeros(0, np.int64)
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        for at in range(0, total, _PAIRS_AT_ONCE):
            pair = np.arange(at, min(total, at + _PAIRS_AT_ONCE))
            of = np.searchsorted(ends, pair, side="right")
            entry = starts[found[of]] + pair - (ends[of] - n[of])
            window = windows[entry]
            start = places[of] - offsets[entry]
            inside = (start >= 0) & (start + index.lengths[window] <= len(ids))
            start, window = start[inside], window[inside]
            beyond = span >= index.lengths[window][:, None]
            same = ((ids_on[start[:, None] + span] == index.windows[window]) | beyond).all(axis=1)
            yield start[same], window[same]


def _count(index: Index):
    """Rows (doc_id, n_words, sha, found): the first row of a batch carries the counts of all its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("doc_id", pa.int64()), ("n_words", pa.int64()), ("sha", pa.binary()),
            ("found", pa.list_(pa.struct([("size", pa.int32()), ("shingle", pa.int64()), ("n", pa.int64())]))),
        ])
        for batch in batches:
            counts = {size: np.zeros(len(known), np.int64) for size, known in index.shingles.items()}
            n_words, digests = [], []
            for body in batch.column(1):
                body = body.as_py()
                words = words_of(body)
                n_words.append(len(words))
                digests.append(hashlib.sha256(body).digest())
                count_shingles(index, words, counts)
            found = [
                {"size": size, "shingle": k, "n": n}
                for size, each in counts.items() for k, n in zip(np.flatnonzero(each).tolist(), each[each > 0].tolist())
            ]
            found = [found] + [[]] * (batch.num_rows - 1) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(digests, pa.binary()), pa.array(found, schema.field(3).type)],
                schema=schema,
            )

    return run


def _match(index: Index):
    """Rows (sha, runs, classes) for documents with hits: covered words as runs (first, end)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("sha", pa.binary()), ("runs", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
            ("classes", pa.list_(pa.string())),
        ])
        for batch in batches:
            out = []
            for body in batch.column(0):
                body = body.as_py()
                words = words_of(body)
                edges, classes = np.zeros(len(words) + 1, np.int64), set()
                for start, window in occurrences(index, words):
                    np.add.at(edges, start, 1)
                    np.add.at(edges, start + index.lengths[window], -1)
                    classes.update(index.classes[w] for w in np.unique(window).tolist())
                if classes:
                    covered = np.concatenate([[0], np.cumsum(edges) > 0])
                    turns = np.flatnonzero(np.diff(covered)).tolist()
                    runs = [{"first": a, "end": b} for a, b in zip(turns[::2], turns[1::2])]
                    out.append({"sha": hashlib.sha256(body).digest(), "runs": runs, "classes": sorted(classes)})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _windows(window_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, windows = [], []
            for item, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(body.as_py())
                size = min(window_words, len(words))
                found = {b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)} if words else ()
                items += [item] * len(found)
                windows += found
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(windows, pa.binary())], names=["item", "window"])

    return run


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, window_words: int) -> tuple[DataFrame, DataFrame]:
    """Tables (window, klass) and (klass, item): windows that the same items have share a class."""
    spread = benchmark.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("item"), utf8(text_col).alias("body"))
    pairs = materialise(spread.mapInArrow(_windows(window_words), "item string, window binary").distinct(), "leaks-items")
    # A set of items is named by sums of hashes, which partial aggregation adds up.
    sums = [F.sum(F.xxhash64(F.lit(seed), "item").cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    windows = materialise(
        pairs.groupBy("window").agg(F.concat_ws(":", F.count("*").cast("string"), *sums).alias("klass")), "leaks-windows"
    )
    one_each = windows.groupBy("klass").agg(F.min("window").alias("window"))
    return windows, materialise(pairs.join(one_each, "window").select("klass", "item"), "leaks-classes")


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window_words: int = WINDOW_WORDS,
                  shingle_words: int = SHINGLE_WORDS, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    if not 1 <= shingle_words <= min(3, window_words):
        raise ValueError("shingles have one to three words, and no more than a window")
    windows, items = benchmark_windows(benchmark, item_col, item_text_col, window_words)
    n_blocks = max(1, -(-windows.count() // (block_windows // 2 or 1)))
    block = F.pmod(F.xxhash64("window"), F.lit(n_blocks))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), utf8(text_col).alias("body"))
    known, hits = None, None
    for number in range(n_blocks):
        rows = [(bytes(r.window), r.klass) for r in windows.where(block == number).collect()]
        index = build_index(rows, window_words, shingle_words)
        sent = spark.sparkContext.broadcast(index)
        counted = materialise(
            texts.mapInArrow(lambda b, sent=sent: _count(sent.value)(b), "doc_id long, n_words long, sha binary, "
                             "found array<struct<size int, shingle long, n long>>"), "leaks-counts",
        )
        if known is None:
            known = counted.select("doc_id", "n_words", "sha")
        counts = {size: np.zeros(len(k), np.int64) for size, k in index.shingles.items()}
        # At most one row a shingle of the block.
        for r in counted.select(F.explode("found").alias("f")).groupBy("f.size", "f.shingle").agg(F.sum("f.n").alias("n")).collect():
            counts[r["size"]][r["shingle"]] = r["n"]
        choose_keys(index, counts, shingle_words)
        sent.unpersist()
        sent = spark.sparkContext.broadcast(index)
        found = materialise(
            texts.select("body").mapInArrow(lambda b, sent=sent: _match(sent.value)(b), "sha binary, "
                                            "runs array<struct<first long, end long>>, classes array<string>"), "leaks-hits",
        )
        hits = found if hits is None else hits.union(found)
        sent.unpersist()
    runs = hits.groupBy("sha").agg(F.array_sort(F.flatten(F.collect_set("runs"))).alias("runs"))
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    n_hit = F.aggregate(
        "runs", start,
        lambda s, r: F.struct(F.greatest(s["end"], r["end"]).alias("end"),
                              (s["n"] + F.greatest(F.lit(0), r["end"] - F.greatest(s["end"], r["first"]))).alias("n")),
        lambda s: s["n"],
    )
    named = materialise(hits.select("sha", F.explode("classes").alias("klass")).distinct(), "leaks-named")
    named = named.join(broadcast_if_bounded(items), "klass").groupBy("sha").agg(F.array_sort(F.collect_set("item")).alias("items"))
    leaks = materialise(
        runs.select("sha", n_hit.alias("n_hit")).join(named, "sha").select(
            "sha", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")
        ), "leaks-documents",
    )
    none = hashlib.sha256(b"").hexdigest()
    n_hit, n_items = (F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("n_hit", "n_items"))
    return known.join(leaks, "sha", "left").select(
        "doc_id", "n_words", n_hit, n_items, F.coalesce("items_sha256", F.lit(none)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


DECONTAMINATION_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), starts AS (
  SELECT item, words, least(10, len(words)) AS size, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS pos
  FROM items WHERE len(words) > 0
), windows AS (
  SELECT DISTINCT item, size, array_to_string(words[pos:pos + size - 1], ' ') AS gram FROM starts
), places AS (
  SELECT doc, words, unnest(range(1, len(words) + 1)) AS pos FROM docs
), hits AS (
  SELECT p.doc, p.pos, w.size, w.item
  FROM (SELECT doc, pos, size, array_to_string(words[pos:pos + size - 1], ' ') AS gram
        FROM places, (SELECT DISTINCT size FROM windows) WHERE pos + size - 1 <= len(words)) p
  JOIN windows w USING (size, gram)
), covered AS (
  SELECT doc, count(DISTINCT place) AS n_hit FROM (SELECT doc, unnest(range(pos, pos + size)) AS place FROM hits) GROUP BY doc
), named AS (
  SELECT doc, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc, item FROM hits) GROUP BY doc
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN covered USING (doc) LEFT JOIN named USING (doc)
"""
