"""Connected components of an edge table, as a loop of joins over written tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, label) for every node of `edges(u, v)`; label is the smallest node reachable.

    Each round takes the smallest label among neighbours and then the label of the label, so
    paths shorten by more than half. Labels are written once a round; a hot node is a hot key
    of a join between two written tables, which adaptive execution splits.
    """
    both = materialise(
        edges.select("u", "v").where("u != v").union(edges.select("v", "u").where("u != v")).distinct(), "edges"
    )
    labels = materialise(
        both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("u"), F.min("v")).alias("label")), "labels"
    )
    while True:
        near = (
            both.join(labels, both["v"] == labels["node"])
            .groupBy(F.col("u").alias("near_node")).agg(F.min("label").alias("near"))
        )
        lowered = materialise(
            labels.join(near, labels["node"] == near["near_node"]).select(
                "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
            ),
            "labels",
        )
        parent = lowered.select(F.col("node").alias("parent"), F.col("label").alias("root"))
        jumped = materialise(
            lowered.join(parent, lowered["label"] == parent["parent"]).select(
                "node", "old", F.least("label", "root").alias("label")
            ),
            "labels",
        )
        labels = jumped.select("node", "label")
        if jumped.where("old != label").isEmpty():
            return labels


def spanning_links(batches: Iterator[pa.RecordBatch], bound: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Reduce rows (node, list of linked nodes) to links (u, v) that join the same nodes.

    Only links that unite two sets seen in this task leave it, at most one less than its nodes,
    however many links there are. Beyond `bound` nodes the sets start anew, which only repeats
    a few links.
    """
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    parent: dict[int, int] = {}

    def find(node: int) -> int:
        root = node
        while (above := parent.setdefault(root, root)) != root:
            root = above
        while parent[node] != root:
            parent[node], node = root, parent[node]
        return root

    for batch in batches:
        us, vs = [], []
        for node, linked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            root = find(node)
            for other in linked:
                if (other_root := find(other)) != root:
                    parent[other_root] = root
                    us.append(node)
                    vs.append(other)
        if us:
            yield pa.RecordBatch.from_pydict({"u": us, "v": vs}, schema=schema)
        if len(parent) > bound:
            parent.clear()
