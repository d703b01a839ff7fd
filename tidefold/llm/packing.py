"""Packing documents into fixed-length sequences by best fit and swap-based local search.

Documents become pieces of at most `capacity` tokens. Pieces are dealt by hash into groups of
bounded expected size; each group is packed by best fit in decreasing order, then improved:
while some bin is underfull, its pieces are moved to fuller bins, exchanged one for one with a
smaller piece there, or two for one. Pieces of one length do equally well, so the search goes over
the distinct lengths of a bin, all of them, until no step is left. Every step raises the sum of
squared fills, and a bin that has been emptied is gone. Pieces are dealt by their place in the
written table as well, so rows that repeat an identifier spread over all groups. The pieces of bins that stay underfull are dealt anew over coarser
groups in further rounds. The work of a task is bounded whatever the input's size; the loss is
at most a bin or so a group of the last round.

Defined cases: a null text counts as empty and still gives one piece, its end token; rows that
repeat an identifier are packed one by one; a null identifier stays null; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidefold.llm.common import materialise
from tidefold.llm.tokens import encoder

CAPACITY = 2048
END_ID = 0
GROUP_PIECES = 1024
ROUNDS = 3
UNDERFULL = 0.97
_PIECE_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32); of a cut document the first piece may be shorter."""
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) + end
                n = len(ids) // 4
                stop = (n - 1) % capacity + 1
                start = piece = 0
                while start < n:
                    rows.append((doc_id, piece, start, stop - start, zlib.crc32(ids[4 * start:4 * stop])))
                    start, stop, piece = stop, stop + capacity, piece + 1
            columns = zip(*rows) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_PIECE_NAMES)

    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("body")
    ).mapInArrow(run, _PIECE_DDL)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best fit in decreasing order: bins as lists of positions in `lengths`."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    present = 0  # bit r: some bin has room r
    for item in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        size = lengths[item]
        above = present >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                present ^= 1 << room
        else:
            room, chosen = capacity, len(bins)
            bins.append([])
        bins[chosen].append(item)
        room -= size
        by_room[room].append(chosen)
        present |= 1 << room
    return bins


def _by_length(lengths: list[int], items: list[int]) -> dict[int, list[int]]:
    """Items of a bin by length, lengths in ascending order."""
    found: dict[int, list[int]] = {}
    for item in sorted(items, key=lengths.__getitem__):
        found.setdefault(lengths[item], []).append(item)
    return found


def _better_exchange(source: dict[int, list[int]], target: dict[int, list[int]], room: int, heavier_by: int):
    """The step from `source` to `target` that fills most: (gain, items out of source, items out of target).

    A step counts if it raises the sum of squared fills: the target gains g tokens with
    g > source fill - target fill, that is g + heavier_by > 0, and g fits into its room. For what
    leaves the source, the shortest piece of the target that makes room fills most.
    """
    gain, out, back = max(0, -heavier_by), None, None
    mine, theirs = list(source), list(target)
    longest = theirs[-1]
    for i, a in enumerate(mine):
        if a - longest > room:
            break  # nor does any longer piece find its place
        if gain < a <= room:
            gain, out, back = a, source[a][:1], []
        at = bisect_left(theirs, a - room)
        if at < len(theirs) and gain < a - theirs[at]:
            gain, out, back = a - theirs[at], source[a][:1], target[theirs[at]][:1]
        for b in mine[i + (len(source[a]) < 2):]:
            if gain == room or a + b - longest > room:
                break
            left = a + b - theirs[bisect_left(theirs, a + b - room)]
            if gain < left:
                gain, out, back = left, [source[a][0], source[b][a == b]], target[a + b - left][:1]
        if gain == room:
            break
    return gain, out, back


def improve(lengths: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Local search: empty the emptiest bins into the others by moves and exchanges, until none helps."""
    fills = [sum(lengths[i] for i in b) for b in bins]
    least = -(-sum(fills) // capacity)
    live, changed = len(bins), True
    known, version = [_by_length(lengths, b) for b in bins], [0] * len(bins)
    tried: dict[tuple[int, int], tuple[int, int]] = {}  # pairs without a step, as long as neither bin changes
    while changed and live > least:
        changed = False
        for source in sorted(range(len(bins)), key=fills.__getitem__):
            if live <= least:
                break
            if not bins[source] or fills[source] == capacity:
                continue
            targets = sorted((t for t in range(len(bins)) if t != source and bins[t] and fills[t] < capacity), key=fills.__getitem__, reverse=True)
            for target in targets:
                if not bins[source]:
                    break
                if tried.get((source, target)) == (version[source], version[target]):
                    continue
                while bins[source] and fills[target] < capacity:
                    gain, out, back = _better_exchange(known[source], known[target], capacity - fills[target], fills[target] - fills[source])
                    if out is None:
                        tried[source, target] = (version[source], version[target])
                        break
                    version[source] += 1
                    version[target] += 1
                    bins[source] = [i for i in bins[source] if i not in out] + back
                    bins[target] = [i for i in bins[target] if i not in back] + out
                    known[source], known[target] = _by_length(lengths, bins[source]), _by_length(lengths, bins[target])
                    fills[source] -= gain
                    fills[target] += gain
                    changed = True
            if not bins[source]:
                live -= 1
    return [b for b in bins if b]


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions: best fit, then local search."""
    return improve(lengths, best_fit(lengths, capacity), capacity)


def _pack_groups(parts: DataFrame, round_no: int, capacity: int, group_pieces: int) -> DataFrame:
    """Pack each hash group; sequence ids are unique over groups and rounds."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.select([*_PIECE_NAMES, "row"]).sort_by([(name, "ascending") for name in ("length", "doc_id", "piece", "start", "row")])
        lengths = group.column("length").to_pylist()
        sequence = np.empty(len(lengths), np.int64)
        offset = np.empty(len(lengths), np.int64)
        for number, members in enumerate(pack_lengths(lengths, capacity)):
            at = 0
            for item in members:
                sequence[item], offset[item] = number, at
                at += lengths[item]
        base = (key[0].as_py() * 16 + round_no) << 24
        return group.append_column("sequence_id", pa.array(sequence + base)).append_column("offset", pa.array(offset))

    groups = max(1, -(-parts.count() // group_pieces))
    dealt = parts.withColumn("part", F.pmod(F.xxhash64("row", F.lit(round_no)), F.lit(groups)))
    schema = f"{_PIECE_DDL}, row long, sequence_id long, offset long"
    return dealt.select(*_PIECE_NAMES, "row", "part").groupBy("part").applyInArrow(run, schema)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, group_pieces: int = GROUP_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    numbered = pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id).withColumn("row", F.monotonically_increasing_id())
    cut = materialise(numbered, "pack-pieces")
    names = [*_PIECE_NAMES, "sequence_id", "offset"]
    full = cut.where(F.col("length") == capacity)
    done = full.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long")).select(names)
    rest = cut.where(F.col("length") < capacity)
    for round_no in range(rounds):
        packed = materialise(_pack_groups(rest, round_no, capacity, group_pieces), "pack-round")
        if round_no == rounds - 1:
            return done.union(packed.select(names))
        filled = packed.withColumn("fill", F.sum("length").over(W.partitionBy("sequence_id")))
        filled = materialise(filled, "pack-filled")
        done = done.union(filled.where(F.col("fill") >= capacity * UNDERFULL).select(names))
        rest = filled.where(F.col("fill") < capacity * UNDERFULL).select(*_PIECE_NAMES, "row")
    return done
