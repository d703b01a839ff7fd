"""Removal of long repeated byte strings by suffix arrays with two-stage sorting.

A byte goes if it lies in a string of `MATCH` bytes that also starts anywhere else in the
corpus. No machine can sort all suffixes of a large corpus, and none needs to: equal windows of
`MATCH` bytes have the same anchor, the place of the smallest hash among their `GRAM`-byte
substrings. So each text is cut into segments, one per anchor, that hold the windows with that
anchor; only segments with the same anchor content can share a window.

1. Anchors that occur once are dropped: nothing in their windows repeats. If all segments of an
   anchor are equal, all of their windows repeat. Neither needs the text.
2. For the rest, each distinct segment travels once, however many texts hold it, to the task that
   owns its anchor. There the segments are joined and their suffixes sorted in two stages: suffixes
   smaller than their successors directly, the others induced by scanning the buckets of first bytes
   in order. Neighbours with a common prefix of `MATCH` bytes are repeats.
3. An anchor with more than `HOT_SEGMENTS` distinct segments (a passage in very many texts, with
   other words around it) would put them all in one task. Its segments are cut, and cut again,
   each time dealt by the bytes that all windows of a part share, until few are together.

Segments, counts and intervals are written tables. Work per text byte is constant apart from the
sorting, which runs over bounded batches.

Defined cases: a null text counts as empty; texts shorter than `MATCH` stay whole; rows that
repeat identifier and text count as two occurrences and both lose the string; an identifier that
repeats with other texts, or is null, is judged by row; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import materialise, utf8

MATCH = 400
GRAM = 32
HOT_SEGMENTS = 512
PARTS = 8
SORT_BYTES = 512 * 1024
_SCAN_BYTES = 4 * 1024 * 1024
_PLACE_BITS = 24
_SEGMENT_DDL = "row_key long, at long, n_windows int, lead int, anchor long, segment binary"


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of every substring of `size` (a power of two) bytes."""
    h, step, base = data.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while step < size:
        h = h[:-step] + h[step:] * np.uint64(base)
        base, step = base * base % (1 << 64), 2 * step
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of `width` values, from running minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1: n])


def anchored_segments(data: np.ndarray, match: int, gram: int) -> tuple[np.ndarray, ...]:
    """First window, number of windows, distance from there to the anchor, and anchor hash of each segment."""
    hashes = gram_hashes(data, gram)
    place = np.uint64((1 << _PLACE_BITS) - 1)
    keys = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
    anchors = sliding_min(keys, match - gram + 1) & place
    starts = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
    counts = np.diff(np.append(starts, len(anchors)))
    places = anchors[starts].astype(np.int64)
    return starts, counts, places - starts, hashes[places]


def _segment_rows(match: int, gram: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ats, counts, leads, anchors, digests = [], [], [], [], [], []
            for row_key, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                view = memoryview(body.as_buffer())
                for begin in range(0, max(len(view) - match + 1, 0), _SCAN_BYTES):
                    part = view[begin: begin + _SCAN_BYTES + match - 1]
                    starts, sizes, distances, hashes = anchored_segments(np.frombuffer(part, np.uint8), match, gram)
                    keys.append(np.full(len(starts), row_key, np.int64))
                    ats.append(starts + begin)
                    counts.append(sizes)
                    leads.append(distances)
                    anchors.append(hashes)
                    digests.extend(
                        xxhash.xxh3_128_digest(part[a:a + n + match - 1]) for a, n in zip(starts.tolist(), sizes.tolist())
                    )
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(keys)), pa.array(np.concatenate(ats)),
                        pa.array(np.concatenate(counts).astype(np.int32)), pa.array(np.concatenate(leads).astype(np.int32)),
                        pa.array(np.concatenate(anchors).view(np.int64)), pa.array(digests, pa.binary()),
                    ],
                    names=["row_key", "at", "n_windows", "lead", "anchor", "segment"],
                )

    return cut


def _smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last is not."""
    n = len(text)
    differs = np.flatnonzero(text[:-1] != text[1:])
    following = np.searchsorted(differs, np.arange(n))
    smaller = np.zeros(n, bool)
    known = following < len(differs)
    at = differs[following[known]]
    smaller[known] = text[at] < text[at + 1]
    return smaller


def _sort_directly(places: np.ndarray, raw: bytes, depth: int) -> np.ndarray:
    """Order `places` by the `depth` bytes that follow; `raw` is padded by as many."""
    words = np.ndarray((len(raw) - 7,), ">u8", raw, strides=(1,))[places]
    order = np.argsort(words, kind="stable")
    places, words = places[order], words[order]
    edges = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1], [True])))
    sizes = np.diff(edges)
    for start, size in zip(edges[:-1][sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        tied = places[start:start + size].tolist()
        tied.sort(key=lambda i: raw[i + 8:i + depth])
        places[start:start + size] = tied
    return places


def two_stage_order(text: bytes, depth: int) -> np.ndarray:
    """Suffix array of `text`, exact for the first `depth` bytes of every suffix.

    Stage one sorts the suffixes that are smaller than their successors. Stage two goes through
    the buckets of first bytes in order: within a bucket the suffixes larger than their successors
    come first, in the order in which their successors were met, then the directly sorted ones.
    """
    raw = text + bytes(depth + 8)
    symbols = np.frombuffer(text, np.uint8)
    n = len(symbols)
    direct = _sort_directly(np.flatnonzero(_smaller_than_successor(symbols)), raw, depth)
    bounds = np.searchsorted(symbols[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n:
        induced[symbols[-1]].append(np.array([n - 1]))
    buckets = []
    for symbol in range(256):
        # Those with the same first byte as their successor follow it in the same bucket.
        chunk = np.concatenate(induced[symbol]) if induced[symbol] else np.empty(0, np.int64)
        larger = []
        while len(chunk):
            larger.append(chunk)
            before = chunk[chunk > 0] - 1
            chunk = before[symbols[before] == symbol]
        bucket = np.concatenate([*larger, direct[bounds[symbol]:bounds[symbol + 1]]])
        if not len(bucket):
            continue
        buckets.append(bucket)
        before = bucket[bucket > 0] - 1
        firsts = symbols[before]
        before, firsts = before[firsts > symbol], firsts[firsts > symbol]
        order = np.argsort(firsts, kind="stable")
        before, firsts = before[order], firsts[order]
        edges = np.flatnonzero(np.concatenate(([True], firsts[1:] != firsts[:-1]))) if len(firsts) else []
        for start, stop in zip(edges, [*edges[1:], len(firsts)]):
            induced[firsts[start]].append(before[start:stop])
    return np.concatenate(buckets) if buckets else np.empty(0, np.int64)


def common_prefixes(order: np.ndarray, text: bytes, depth: int) -> np.ndarray:
    """Whether each neighbouring pair of `order` has `depth` bytes in common, found eight bytes at a time."""
    words = np.ndarray((len(text) + 1,), "<u8", text + bytes(8), strides=(1,))
    alive = np.arange(len(order) - 1)
    a, b = order[:-1], order[1:]
    for offset in [*range(0, depth - 7, 8), *([depth - 8] if depth % 8 else [])]:
        alive = alive[words[a[alive] + offset] == words[b[alive] + offset]]
        if not len(alive):
            break
    same = np.zeros(max(len(order) - 1, 0), bool)
    same[alive] = True
    return same


def repeated_windows(segments: list[bytes], match: int) -> list[np.ndarray]:
    """Per segment, whether each of its windows equals another window of the list."""
    text = b"".join(segments)
    starts = np.cumsum([0, *map(len, segments)])
    valid = np.zeros(len(text), bool)
    for start, segment in zip(starts, segments):
        valid[start:start + len(segment) - match + 1] = True
    order = two_stage_order(text, match)
    order = order[valid[order]]
    same = common_prefixes(order, text, match)
    repeated = np.zeros(len(text), bool)
    repeated[order[:-1][same]] = True
    repeated[order[1:][same]] = True
    return [repeated[start:start + len(segment) - match + 1] for start, segment in zip(starts, segments)]


def _runs(flags: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return [{"first": int(a), "stop": int(b)} for a, b in zip(edges[::2], edges[1::2])]


_RUNS = pa.list_(pa.struct([("first", pa.int32()), ("stop", pa.int32())]))
_FOUND = pa.schema([("anchor", pa.int64()), ("segment", pa.binary()), ("runs", _RUNS)])
_FOUND_DDL = "anchor long, segment binary, runs array<struct<first:int,stop:int>>"


def _sort_rows(match: int, sort_bytes: int):
    """Suffix-sort segments that come in the order of their anchors, whole anchors in bounded batches."""

    def solve(held: list[tuple]) -> pa.RecordBatch:
        flags = repeated_windows([body for _, _, body in held], match)
        rows = [(a, s, _runs(f)) for (a, s, _), f in zip(held, flags) if f.any()]
        columns = list(zip(*rows)) if rows else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for anchor, segment, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if size >= sort_bytes and anchor != last:
                    yield solve(held)
                    held, size = [], 0
                held.append((anchor, segment, body))
                size, last = size + len(body), anchor
        if held:
            yield solve(held)

    return run


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (body, wanted segments) to one row per segment with its bytes."""
    schema = pa.schema([("anchor", pa.int64()), ("segment", pa.binary()), ("hot", pa.bool_()), ("copies", pa.int64()), ("lead", pa.int32()), ("bytes", pa.binary())])
    for batch in batches:
        rows = []
        for body, wanted in zip(batch.column(0), batch.column(1).to_pylist()):
            view = memoryview(body.as_buffer())
            rows.extend(
                (w["anchor"], w["segment"], w["hot"], w["copies"], w["lead"], bytes(view[w["at"]:w["at"] + w["n_bytes"]])) for w in wanted
            )
        columns = list(zip(*rows)) if rows else [[]] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _part_rows(match: int, size: int):
    """Blocks of windows to the parts of aligned ranges of `size`, keyed by what such a range has in common.

    A window is known by how far it reaches ahead of its anchor, so equal windows are in the
    same range whatever segment they come from. All windows that reach `low` to `low + size`
    ahead have the bytes from `low` ahead to `match` behind the last of them.
    """
    schema = pa.schema([
        ("anchor", pa.int64()), ("segment", pa.binary()), ("copies", pa.int64()), ("offset", pa.int32()), ("lead", pa.int32()),
        ("bytes", pa.binary()), ("key", pa.binary()), ("content", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            rows = []
            for anchor, segment, copies, offset, lead, block in zip(*(c.to_pylist() for c in batch.columns)):
                n, start = len(block) - match + 1, 0
                while start < n:
                    ahead = lead - start
                    low = ahead // size * size
                    stop = min(n, start + ahead - low + 1)
                    part = block[start:stop + match - 1]
                    core = part[ahead - low:ahead - (low + size - 1) + match]
                    key = digest(b"%d,%d,%d:" % (anchor, size, low) + core)
                    rows.append((anchor, segment, copies, offset + start, ahead, part, key, digest(part)))
                    start = stop
            columns = list(zip(*rows)) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


_PART_DDL = "anchor long, segment binary, copies long, offset int, lead int, bytes binary, key binary, content binary"


def _repeated_in_hot(segments: DataFrame, match: int, hot_segments: int, sort_bytes: int) -> DataFrame:
    """Rows (anchor, segment, runs) for anchors with too many segments for one task.

    Blocks of windows are cut and dealt anew by what all windows of a part have in common.
    Parts alone under their key are done, and so are keys whose parts are all equal; keys with
    few parts are suffix-sorted; what is left is cut again, down to single windows, which are
    equal under a key. A level cuts a row into `PARTS` at most, and at a border between shared
    and own text mostly one of them is left.
    """
    n_windows = F.length("bytes") - (match - 1)
    whole = F.array(F.struct(F.col("offset").alias("first"), (F.col("offset") + n_windows).alias("stop")))
    blocks = materialise(
        segments.where("hot").select(
            "anchor", "segment", "copies", F.lit(0).alias("offset"), "lead", "bytes"
        ),
        "suffix-blocks",
    )
    found = blocks.select("anchor", "segment", whole.alias("runs")).where("false")
    size = 1 << (match - 1).bit_length()
    while not blocks.isEmpty():
        size = max(1, size // PARTS)
        parts = materialise(blocks.mapInArrow(_part_rows(match, size), _PART_DDL), "suffix-parts")
        keys = materialise(
            parts.groupBy("key").agg(
                F.count("*").alias("n"), F.sum("copies").alias("times"), (F.min("content") == F.max("content")).alias("all_equal")
            ).where("times > 1"),
            "suffix-keys",
        )
        dealt = materialise(parts.join(keys, "key"), "suffix-dealt")
        equal = dealt.where("all_equal").select("anchor", "segment", whole.alias("runs"))
        few = dealt.where(~F.col("all_equal") & (F.col("n") <= hot_segments))
        # Equal parts under one key are sorted once.
        sorted_runs = (
            few.select(F.xxhash64("key").alias("anchor"), F.concat("key", "content").alias("segment"), "bytes")
            .dropDuplicates(["anchor", "segment"])
            .repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_sort_rows(match, sort_bytes), _FOUND_DDL)
            .select(F.col("segment").alias("sorted"), "runs")
        )
        copied = few.groupBy(F.concat("key", "content").alias("sorted")).agg(F.sum("copies").alias("all_copies"))
        marks = materialise(sorted_runs.join(copied, "sorted", "right"), "suffix-few")
        shifted = F.transform("runs", lambda r: F.struct((r["first"] + F.col("offset")).alias("first"), (r["stop"] + F.col("offset")).alias("stop")))
        sorted_found = (
            few.join(marks, F.concat("key", "content") == F.col("sorted"))
            .select("anchor", "segment", F.when(F.col("all_copies") > 1, whole).otherwise(shifted).alias("runs"))
            .where("runs IS NOT NULL")
        )
        found = found.union(materialise(equal.union(sorted_found), "suffix-level"))
        blocks = dealt.where(~F.col("all_equal") & (F.col("n") > hot_segments)).select("anchor", "segment", "copies", "offset", "lead", "bytes")
    return found.select("anchor", "segment", F.explode("runs").alias("r")).groupBy("anchor", "segment").agg(
        F.array_sort(F.collect_list("r")).alias("runs")
    )


def repeated_intervals(rows: DataFrame, match: int = MATCH, gram: int = GRAM, hot_segments: int = HOT_SEGMENTS,
                       sort_bytes: int = SORT_BYTES) -> DataFrame:
    """Rows (row_key, spans) for `rows(row_key, body)`: the repeated places of each text that has some."""
    segments = materialise(rows.mapInArrow(_segment_rows(match, gram), _SEGMENT_DDL), "suffix-segments")
    anchors = materialise(
        segments.groupBy("anchor").agg(
            F.count("*").alias("n"), (F.min("segment") == F.max("segment")).alias("all_equal")
        ).where("n > 1").select("anchor", "all_equal"),
        "suffix-anchors",
    )
    shared = materialise(segments.join(anchors, "anchor"), "suffix-shared")
    distinct = materialise(
        shared.where(~F.col("all_equal")).groupBy("anchor", "segment").agg(
            F.count("*").alias("copies"), F.min(F.struct("row_key", "at", "n_windows", "lead")).alias("one")
        ),
        "suffix-distinct",
    )
    crowded = materialise(distinct.groupBy("anchor").agg((F.count("*") > hot_segments).alias("hot")), "suffix-crowded")
    wanted = distinct.join(crowded, "anchor").groupBy(F.col("one.row_key").alias("row_key")).agg(
        F.collect_list(F.struct(
            "anchor", "segment", "hot", "copies", F.col("one.lead").alias("lead"), F.col("one.at").alias("at"),
            (F.col("one.n_windows") + (match - 1)).alias("n_bytes"),
        )).alias("wanted")
    )
    # Rows that repeat identifier and text have one key; one of them is enough here.
    bytes_of = (
        rows.join(materialise(wanted, "suffix-wanted"), "row_key").select("body", "wanted")
        .mapInArrow(_cut_rows, "anchor long, segment binary, hot boolean, copies long, lead int, bytes binary")
    )
    bytes_of = materialise(bytes_of, "suffix-bytes")
    sorted_found = (
        bytes_of.where(~F.col("hot")).select("anchor", "segment", "bytes").dropDuplicates(["anchor", "segment"])
        .repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_sort_rows(match, sort_bytes), _FOUND_DDL)
    )
    hot = _repeated_in_hot(bytes_of.where("hot").dropDuplicates(["anchor", "segment"]), match, hot_segments, sort_bytes)
    found = materialise(sorted_found.union(hot), "suffix-found")
    spans_of = F.struct((F.col("at") + F.col("r.first")).alias("start"), (F.col("at") + F.col("r.stop") + (match - 1)).alias("stop"))
    whole = F.array(F.struct(F.lit(0).alias("first"), F.col("n_windows").alias("stop")))
    copied = distinct.where("copies > 1").select("anchor", "segment", F.lit(True).alias("copied"))
    marks = materialise(
        copied.join(found, ["anchor", "segment"], "full").select("anchor", "segment", F.coalesce("copied", F.lit(False)).alias("copied"), "runs"),
        "suffix-marks",
    )
    equal = shared.where("all_equal").select("row_key", "at", whole.alias("runs"))
    marked = shared.where(~F.col("all_equal")).join(marks, ["anchor", "segment"]).select(
        "row_key", "at", F.when(F.col("copied"), whole).otherwise(F.col("runs")).alias("runs")
    )
    spans = equal.union(marked).select("row_key", "at", F.explode("runs").alias("r")).select("row_key", spans_of.alias("span"))
    return materialise(spans.groupBy("row_key").agg(F.collect_list("span").alias("spans")), "suffix-spans")


def _strip_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        for body, spans in zip(batch.column(1), batch.column(2)):
            view = memoryview(body.as_buffer())
            keep, removed, runs, at = hashlib.sha256(), 0, 0, 0
            stop = 0
            for span in sorted((s["start"], s["stop"]) for s in (spans.as_py() or ())):
                if span[0] > stop or runs == 0:
                    keep.update(view[at:span[0]])
                    runs += 1
                    removed += span[1] - span[0]
                    stop = span[1]
                elif span[1] > stop:
                    removed += span[1] - stop
                    stop = span[1]
                at = stop
            keep.update(view[at:])
            for name, value in zip(out, (len(view), removed, runs, keep.hexdigest())):
                out[name].append(value)
        yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out.values())], names=["doc_id", *out])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", match: int = MATCH, gram: int = GRAM,
                   hot_segments: int = HOT_SEGMENTS, sort_bytes: int = SORT_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), utf8(text_col).alias("body")
    ).withColumn("row_key", F.xxhash64("doc_id", "body"))
    spans = repeated_intervals(rows.select("row_key", "body"), match, gram, hot_segments, sort_bytes)
    return rows.join(spans, "row_key", "left").select("doc_id", "body", "spans").mapInArrow(
        _strip_rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
