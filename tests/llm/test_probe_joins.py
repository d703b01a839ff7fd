"""Exploded rows are never broadcast, however small Spark's estimate of them."""

from __future__ import annotations

from tidefold.llm import near_copies, simhash
from tidefold.llm.components import connected_components


def _plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_probes_and_entries_are_not_broadcast(spark, monkeypatch):
    written, plans = simhash.materialise, []

    def noted(rows, label):
        plans.append(_plan(rows))
        return written(rows, label)

    monkeypatch.setattr(simhash, "materialise", noted)
    # Read from files: Spark sizes them by their bytes, and what is exploded from them by little more.
    fps = [1 << 40, 1 << 40 | 1, 1 << 40 | 3, 1 << 41 | 1 << 8, -1]
    stored = written(spark.createDataFrame([(fp,) for fp in fps], "fp long"), "probes")
    found = simhash.links(stored)
    plans.append(_plan(found))
    assert not [plan for plan in plans if "BroadcastExchange" in plan]
    assert sum(plan.count("SortMergeJoin") for plan in plans) == 2
    labels = {r.node: r.label for r in connected_components(found).collect()}
    assert labels == {fp: 1 << 40 for fp in fps[:4]}


def test_near_copies_broadcast_no_probes(spark, monkeypatch):
    plans, links = [], simhash.links

    def noted(rows):
        plans.append(_plan(found := links(rows)))
        return found

    monkeypatch.setattr(near_copies, "links", noted)
    words = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, words), (2, f"{words} more"), (3, "nothing like it at all")], "doc_id long, text string")
    gone = near_copies.near_copies(docs).select("node.doc_id").collect()
    assert [r.doc_id for r in gone] == [2]
    assert plans and not [plan for plan in plans if "BroadcastExchange" in plan]
