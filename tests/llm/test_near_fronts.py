"""The near-copy stage fetches by SimHash, too, and does not verify all pairs of a group of loose copies."""

from __future__ import annotations

import random

import corpus_pipeline
from tidefold.llm import near_copies
from tidefold.llm.near_copies import jaccard, shingles

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _loose(rng, n, edits):
    base = [f"w{rng.randrange(900)}" for _ in range(120)]
    made = []
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(len(words)), rng.choice(edits)):
            words[at] = f"new{rng.random()}"
        made.append(" ".join(words))
    return made


def _kept(texts):
    kept = []
    for i, text in enumerate(texts):
        mine = shingles(text.encode())
        if all(jaccard(mine, other) < 0.8 for _, other in kept):
            kept.append((i, mine))
    return [i for i, _ in kept]


def test_loose_copies_are_met_from_the_front(spark, sf_dir, monkeypatch):
    """Most pairs are alike, and yet about as many are verified as there are texts and keys."""
    rng, verified = random.Random(7), []
    texts = _loose(rng, 300, [1, 1, 2, 3])
    sets = [shingles(t.encode()) for t in texts]
    alike = sum(jaccard(sets[i], sets[j]) >= 0.8 for j in range(len(sets)) for i in range(j))
    real = near_copies._alike

    def counted(pairs, *more):
        verified.append(pairs.count())
        return real(pairs, *more)

    monkeypatch.setattr(near_copies, "_alike", counted)
    monkeypatch.setattr(near_copies, "FRONT", 4)
    nodes = spark.createDataFrame([((False, i, 0), t.encode()) for i, t in enumerate(texts)],
                                  "node struct<no_id: boolean, doc_id: bigint, tie: bigint>, body binary")
    # Half of the texts have a second key that orders them differently.
    active = nodes.selectExpr("7L as key", "node").union(nodes.where("node.doc_id % 2 = 0").selectExpr("node.doc_id % 5 as key", "node"))
    gone = {r["node"].doc_id for r in near_copies._fronts(active, nodes, 0.8, 5).collect()}
    assert sorted(set(range(300)) - gone) == _kept(texts)
    assert alike > 6000 and sum(verified) < alike / 4


def test_fingerprints_alone_fetch_a_copy(spark, sf_dir, monkeypatch):
    """Without min-hash keys copies within 3 bits are still found."""
    monkeypatch.setattr(near_copies, "sketch", lambda body, words: (near_copies.np.arange(near_copies.BANDS) + hash(body), 0))
    words = [f"w{i % 700}" for i in range(4000)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"]), "no copy of the others"]
    docs = spark.createDataFrame([(i, t, "en", "s", 9) for i, t in enumerate(texts)], SCHEMA)
    assert [r["node"].doc_id for r in near_copies.near_copies(docs).collect()] == [1]


def test_a_text_meets_the_nearest_that_stays(spark, sf_dir, monkeypatch, tmp_path):
    """Rows that the comparison of sketches gives: about one a text, whatever it is alike to, and once for all keys."""
    texts = _loose(random.Random(9), 400, [1, 1, 2, 3])
    real, log = near_copies._close, str(tmp_path / "rows")

    def counted(*args):
        inner = real(*args)

        def run(batches):
            for batch in inner(batches):
                with open(log, "a") as out:
                    out.write(f"{batch.num_rows}\n")
                yield batch

        return run

    monkeypatch.setattr(near_copies, "_close", counted)
    monkeypatch.setattr(near_copies, "FRONT", 16)
    nodes = spark.createDataFrame([((False, i, 0), t.encode()) for i, t in enumerate(texts)],
                                  "node struct<no_id: boolean, doc_id: bigint, tie: bigint>, body binary")
    active = nodes.selectExpr("explode(array(1L, 2L, 3L)) as key", "node")
    gone = {r["node"].doc_id for r in near_copies._fronts(active, nodes, 0.8, 5).collect()}
    assert sorted(set(range(400)) - gone) == _kept(texts)
    with open(log) as rows:
        assert sum(map(int, rows)) < 4 * len(texts)
