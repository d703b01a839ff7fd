"""Exact deduplication by Patricia-trie owners.

Every task first puts its own rows into a compressed radix trie, so that a text leaves a task
once, however often it occurs there. The distinct texts are dealt by length and content hash;
an owner partition inserts the full byte strings into a trie whose terminals hold the
identifier that stays and the number of rows. An owner sees its texts in the order of their
first bytes, so subtrees are complete one after the other; when a trie outgrows its bound, its
terminals leave as rows and the trie starts anew. What left early is merged by the sums that
follow, so the bound never changes the result.

Defined cases: a null text counts as empty, and all empty texts are equal; a null identifier
ranks below every other; rows that repeat identifier and text count as rows of the group and
share one verdict; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import materialise, utf8

TRIE_BYTES = 64 * 1024 * 1024
SUBTREE_BYTES = 16

_COMBINED = pa.schema(
    [("n_bytes", pa.int64()), ("text_sha256", pa.binary()), ("body", pa.binary()),
     ("keep_id", pa.int64()), ("group_size", pa.int64())]
)
_OWNED = pa.schema([f for f in _COMBINED if f.name != "body"])
_KEYED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("text_sha256", pa.binary())])
_OWNED_DDL = "n_bytes long, text_sha256 binary, keep_id long, group_size long"
_COMBINED_DDL = "n_bytes long, text_sha256 binary, body binary, keep_id long, group_size long"


def _common_prefix(label: bytes, key: bytes, start: int) -> int:
    """Length of the longest prefix of `label` found in `key` at `start`."""
    low, high = 0, min(len(label), len(key) - start)
    while low < high:
        middle = (low + high + 1) // 2
        if key.startswith(label[low:middle], start + low):
            low = middle
        else:
            high = middle - 1
    return low


class _Node:
    __slots__ = ("label", "children", "identifier", "count")

    def __init__(self, label: bytes):
        self.label = label
        self.children: dict[int, _Node] = {}
        self.identifier: int | None = None
        self.count = 0


class PatriciaTrie:
    """Compressed radix trie; a terminal (count > 0) keeps one identifier of equal keys."""

    def __init__(self, keep_largest: bool):
        self.keep_largest = keep_largest
        self.clear()

    def clear(self) -> None:
        self.root = _Node(b"")
        self.n_bytes = 0

    def insert(self, key: bytes, identifier: int | None, count: int = 1) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = _Node(key[at:])
                node.children[key[at]] = child
                self.n_bytes += len(child.label) + 200
                node, at = child, len(key)
            elif key.startswith(child.label, at):
                node, at = child, at + len(child.label)
            else:
                shared = _common_prefix(child.label, key, at)
                fork = _Node(child.label[:shared])
                child.label = child.label[shared:]
                fork.children[child.label[0]] = child
                node.children[key[at]] = fork
                self.n_bytes += 200
                node, at = fork, at + shared
        if node.count == 0 or self._wins(identifier, node.identifier):
            node.identifier = identifier
        node.count += count

    def _wins(self, new: int | None, old: int | None) -> bool:
        if new is None or old is None:
            return old is None
        return new > old if self.keep_largest else new < old

    def terminals(self) -> Iterator[tuple[bytes, int | None, int]]:
        stack = [(self.root, b"")]
        while stack:
            node, prefix = stack.pop()
            key = prefix + node.label
            if node.count:
                yield key, node.identifier, node.count
            stack.extend((child, key) for child in node.children.values())


def _emit(trie: PatriciaTrie, schema: pa.Schema, rows_per_batch: int = 2000) -> Iterator[pa.RecordBatch]:
    columns: dict[str, list] = {name: [] for name in schema.names}
    for key, identifier, count in trie.terminals():
        row = {
            "n_bytes": len(key), "text_sha256": hashlib.sha256(key).digest(), "body": key,
            "keep_id": identifier, "group_size": count,
        }
        for name, values in columns.items():
            values.append(row[name])
        if len(columns["n_bytes"]) == rows_per_batch:
            yield pa.RecordBatch.from_pydict(columns, schema=schema)
            columns = {name: [] for name in schema.names}
    if columns["n_bytes"]:
        yield pa.RecordBatch.from_pydict(columns, schema=schema)


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_largest: bool = True,
    trie_bytes: int = TRIE_BYTES,
) -> DataFrame:
    """One row per distinct text (A-Z lower-cased): n_bytes, text_sha256 (binary), keep_id, group_size."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie(keep_largest)
        for batch in batches:
            for identifier, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                trie.insert(body.as_py().lower(), identifier)
                if trie.n_bytes > trie_bytes:
                    yield from _emit(trie, _COMBINED)
                    trie.clear()
        yield from _emit(trie, _COMBINED)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, subtree = PatriciaTrie(keep_largest), b""
        for batch in batches:
            for body, identifier, count in zip(
                batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            ):
                body = body.as_py()
                complete = body[:SUBTREE_BYTES] != subtree
                subtree = body[:SUBTREE_BYTES]
                if trie.n_bytes > (trie_bytes if complete else 2 * trie_bytes):
                    yield from _emit(trie, _OWNED)
                    trie.clear()
                trie.insert(body, identifier, count)
        yield from _emit(trie, _OWNED)

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), utf8(text_col).alias("body"))
    combined = texts.mapInArrow(combine, _COMBINED_DDL)
    owned = (
        combined.repartition("n_bytes", "text_sha256")
        .select("body", "keep_id", "group_size")
        .sortWithinPartitions(F.substring("body", 1, SUBTREE_BYTES))
        .mapInArrow(own, _OWNED_DDL)
    )
    best = F.max("keep_id") if keep_largest else F.min("keep_id")
    return owned.groupBy("n_bytes", "text_sha256").agg(
        best.alias("keep_id"), F.sum("group_size").alias("group_size")
    )


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths, digests = [], []
        for body in batch.column(1):
            body = body.as_py().lower()
            lengths.append(len(body))
            digests.append(hashlib.sha256(body).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(lengths, pa.int64()), pa.array(digests, pa.binary())], schema=_KEYED
        )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_largest: bool = True,
    trie_bytes: int = TRIE_BYTES,
) -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256.

    The groups are a written table, so the join back has an exchange on both sides and a text
    with a third of all rows is split among tasks.
    """
    groups = materialise(exact_groups(docs, id_col, text_col, keep_largest, trie_bytes), "exact-groups")
    keyed = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), utf8(text_col).alias("body")
    ).mapInArrow(_key_rows, "doc_id long, n_bytes long, text_sha256 binary")
    return keyed.join(groups, ["n_bytes", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("text_sha256")).alias("text_sha256"),
    )
