"""Bounds that hold however ids repeat, and exact answers for small cases of training and packing."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidefold.llm.packing import _pack_groups, pack_lengths
from tidefold.llm.token_scan import token_counts
from tidefold.llm.toxicity import ALPHA, BETA, L1, L2, _training_rows, train_ftrl


def test_training_rows_are_bounded_by_the_limit(spark):
    docs = spark.range(3000).selectExpr("case when id < 2900 then 1 else id end as doc_id", "concat('text ', id % 7) as text")
    labels = spark.range(3000).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    rows = _training_rows(docs, labels, "doc_id", "text", "toxic", 10).collect()
    assert len(rows) == 10
    everything = _training_rows(docs, labels, "doc_id", "text", "toxic", 10_000).collect()
    orders = [r.order for r in everything]
    assert len(set(orders)) == len(orders) <= 101 and {r.order for r in rows} == set(sorted(orders)[:10])


def _plain_ftrl(rows, epochs):
    """FTRL-proximal coordinate by coordinate."""
    z, n = {}, {}

    def weight(at, penalty):
        if abs(z.get(at, 0.0)) <= penalty:
            return 0.0
        return -(z[at] - math.copysign(penalty, z[at])) / ((BETA + math.sqrt(n[at])) / ALPHA + L2)

    for _ in range(epochs):
        for label, at in rows:
            each = {"bias": 0.0, **dict.fromkeys(at, L1)}
            now = {i: weight(i, penalty) for i, penalty in each.items()}
            gradient = 1 / (1 + math.exp(-sum(now.values()))) - label
            for i, w in now.items():
                before = n.get(i, 0.0)
                n[i] = before + gradient**2
                z[i] = z.get(i, 0.0) + gradient - (math.sqrt(n[i]) - math.sqrt(before)) / ALPHA * w
    return {i: weight(i, 0.0 if i == "bias" else L1) for i in z}


def test_ftrl_equals_plain_python():
    rng = random.Random(3)
    rows = []
    for _ in range(300):
        label = rng.randrange(2)
        at = {rng.randrange(40) for _ in range(8)} | ({100 + rng.randrange(3)} if label else set())
        rows.append((label, np.array(sorted(at))))
    weights, bias = train_ftrl(rows, 3)
    wanted = _plain_ftrl([(label, at.tolist()) for label, at in rows], 3)
    assert math.isclose(bias, wanted.pop("bias"), rel_tol=1e-9)
    used = {i: w for i, w in wanted.items() if w}
    assert set(np.flatnonzero(weights).tolist()) == set(used) and {100, 101, 102} <= set(used)
    assert all(math.isclose(weights[i], w, rel_tol=1e-9) for i, w in used.items())


def _least_bins(lengths, capacity):
    """Exact, by trying every bin for every piece."""
    best = len(lengths)

    def place(i, fills):
        nonlocal best
        if len(fills) >= best:
            return
        if i == len(lengths):
            best = len(fills)
            return
        for at in range(len(fills)):
            if fills[at] + lengths[i] <= capacity and fills[at] not in fills[:at]:
                place(i + 1, [*fills[:at], fills[at] + lengths[i], *fills[at + 1:]])
        place(i + 1, [*fills, lengths[i]])

    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_packing_small_cases_against_the_exact_least(lengths):
    least = _least_bins(lengths, 20)
    assert least <= len(pack_lengths(lengths, 20)) <= least + 1


def test_local_search_looks_at_all_pieces_of_a_bin():
    # Forty pieces of one token stand before the pieces that fit; 60 + 40 and 58 + 42 fill two bins.
    rng, short = random.Random(4), 0
    for _ in range(40):
        lengths = [rng.randrange(1, 12) for _ in range(200)]
        short += len(pack_lengths(lengths, 100)) - -(-sum(lengths) // 100)
    assert short == 0


def test_repeated_rows_spread_over_all_groups(spark):
    parts = spark.range(20_000).selectExpr(
        "cast(null as long) as doc_id", "0 as piece", "0L as start", "cast(1 + id % 90 as long) as length", "1L as ids_crc32", "id as row"
    )
    packed = _pack_groups(parts, 0, 2048, 1000)
    sizes = [r["count"] for r in packed.groupBy(F.shiftright("sequence_id", 28).alias("g")).count().collect()]
    assert len(sizes) == 20 and sum(sizes) == 20_000 and max(sizes) < 1500


def test_ids_wider_than_their_files_are_an_error(odd_docs, word_bpe):
    with pytest.raises(Exception, match="does not fit into 1 bytes"):
        token_counts(odd_docs, word_bpe, 0, id_bytes=1).collect()
    assert token_counts(odd_docs, word_bpe, 49407, id_bytes=4).count() == odd_docs.count()
