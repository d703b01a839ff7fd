"""Near copies at 0.8 of five-word shingles, against all pairs in plain Python."""

from __future__ import annotations

import random

import corpus_pipeline
from tidefold.llm.near_copies import jaccard, parity_sketch, shingles, sketch, sketched_pairs
from tidefold.llm.simhash import text_fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _edited(rng, words, edits):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"new{rng.random()}"
    return words


def _pairs(rng, n_words, n):
    """Pairs at or just above 0.8."""
    while n:
        words = [f"w{rng.randrange(5000)}" for _ in range(n_words)]
        one, two = (" ".join(w).encode() for w in (words, _edited(rng, words, max(1, round(n_words * 0.0235)))))
        if 0.8 <= jaccard(shingles(one), shingles(two)) < 0.83:
            n -= 1
            yield one, two


def test_recall_of_bands():
    rng, found, close, n = random.Random(1), 0, 0, 0
    for n_words in (250, 1000):
        for one, two in _pairs(rng, n_words, 100):
            n += 1
            found += bool(set(sketch(one)[0].tolist()) & set(sketch(two)[0].tolist()))
            close += (text_fingerprint(one) ^ text_fingerprint(two)).bit_count() <= 3
    print("recall", found, "of", n, "- 3-word fingerprints within 3 bits:", close)
    assert found >= 0.97 * n


def _kept(rows):
    """Documents in order of doc_id stay unless alike to one that stays."""
    kept = []
    for doc_id, text in sorted(rows):
        if all(jaccard(shingles(text.encode()), other) < 0.8 for _, other in kept):
            kept.append((doc_id, shingles(text.encode())))
    return [doc_id for doc_id, _ in kept]


def test_stage_equals_all_pairs(spark, sf_dir):
    rng, rows = random.Random(2), []
    for _ in range(12):
        base = [f"w{rng.randrange(900)}" for _ in range(200)]
        walk = base
        for step in range(12):
            walk = _edited(rng, walk, 2)  # a chain: neighbours are alike, its ends are not
            rows += [" ".join(walk), " ".join(_edited(rng, base, rng.choice([1, 4, 12])))]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    wanted = _kept(rows)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    got = sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, sf_dir).collect())
    assert got == wanted and 12 < len(wanted) < len(rows)


def test_edited_copy_goes_and_chain_end_stays(spark, sf_dir):
    rng = random.Random(3)
    one, two = next(_pairs(rng, 250, 1))
    words = [f"c{i}" for i in range(200)]
    chain = [words, _edited(rng, words, 3)]
    chain.append(_edited(rng, chain[1], 3))
    texts = [one.decode(), two.decode(), *(" ".join(c) for c in chain)]
    assert jaccard(*(shingles(t.encode()) for t in (texts[2], texts[4]))) < 0.8
    docs = spark.createDataFrame([(i, t, "en", "s", 9) for i, t in enumerate(texts)], SCHEMA)
    got = sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, sf_dir).collect())
    assert got == [0, 2, 4]


def test_repeated_rows_leave_one(spark, sf_dir):
    rng = random.Random(4)
    base = [f"w{rng.randrange(900)}" for _ in range(200)]
    text, near, other = " ".join(base), " ".join(_edited(rng, base, 2)), "something else altogether"
    rows = [(1, text), (1, text), (1, text.upper()), (1, other), (None, other), (None, other), (2, near), (2, near), (3, "x"), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 9) for i, t in rows], SCHEMA)
    exact = corpus_pipeline.drop_exact_copies(spark, docs, sf_dir)
    got = sorted((r.doc_id or 0, (r.text or "").lower()) for r in exact.collect())
    assert got == sorted([(1, text), (1, other), (2, near), (3, "x"), (0, "")])
    left = corpus_pipeline.drop_near_copies(spark, docs, sf_dir).collect()
    assert sorted((r.doc_id or 0, (r.text or "").lower()[:9]) for r in left) == sorted([(1, text[:9]), (1, other[:9]), (3, "x"), (0, "")])


def _group(rng, n, edits):
    """Edited copies of one text, each with edits of its own: alike to the text, less so to each other."""
    base = [f"w{rng.randrange(900)}" for _ in range(200)]
    return [" ".join(_edited(rng, base, edits)) for _ in range(n)]


def _met(spark, texts, **sizes):
    """Pairs that are verified where all texts share a key."""
    node = "struct<no_id: boolean, doc_id: bigint, tie: bigint>"
    frame = spark.createDataFrame([((False, i, 0), t.encode()) for i, t in enumerate(texts)], f"node {node}, body binary").repartition(3)
    active = frame.selectExpr("7L as key", "node")
    found = [(r["first"].doc_id, r["node"].doc_id) for r in sketched_pairs(active, frame, 0.8, 5, **sizes).collect()]
    assert len(set(found)) == len(found) and all(a < b for a, b in found)
    return set(found)


def test_pairs_of_an_unlike_group_do_not_grow_with_its_square(spark):
    rng = random.Random(5)
    made = {}
    for n in (100, 400):
        texts = _group(rng, n, 4)
        shares = [jaccard(shingles(a.encode()), shingles(b.encode())) for a, b in zip(texts, texts[1:])]
        assert 0.6 < sum(shares) / len(shares) < 0.76
        made[n] = len(_met(spark, texts))
    print("pairs to verify", made)
    assert made[400] <= 400 and made[400] <= 4 * max(made[100], 25)


def test_sketches_miss_nothing(spark):
    rng = random.Random(6)
    texts = [t for edits in (1, 3, 4, 5, 8) for t in _group(rng, 12, edits)]
    texts += [" ".join(t.split()[:n]) for t in texts[:6] for n in (3, 120, 135, 150, 165, 185)] + ["", "one two", "one two", " "]
    sets = [shingles(t.encode()) for t in texts]
    alike = {(i, j) for j in range(len(texts)) for i in range(j) if jaccard(sets[i], sets[j]) >= 0.8}
    assert len({len(parity_sketch(t.encode())[1]) for t in texts}) > 1
    for sizes in ({}, {"chunk_bytes": 1500}):
        got = _met(spark, texts, **sizes)
        assert alike <= got and len(alike) > 100 and len(got) < 1.2 * len(alike)
