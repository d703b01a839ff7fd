"""Exact and near deduplication, and removal of repeated strings, against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import ROWS
from tidefold.llm import suffix_dedup
from tidefold.llm.components import connected_components
from tidefold.llm.exact_dedup import PatriciaTrie, exact_dedup
from tidefold.llm.simhash import links, simhash_components, text_fingerprint


def test_trie_keeps_one_identifier_a_key():
    trie = PatriciaTrie(keep_largest=True)
    for key, identifier in [(b"", 1), (b"abc", 2), (b"abd", 3), (b"ab", 4), (b"abc", 9), (b"abc", None), (b"", 0)]:
        trie.insert(key, identifier)
    assert sorted(trie.terminals()) == [(b"", 1, 2), (b"ab", 4, 1), (b"abc", 9, 3), (b"abd", 3, 1)]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(max_size=6)))
def test_trie_counts_like_a_dictionary(keys):
    trie = PatriciaTrie(keep_largest=False)
    for i, key in enumerate(keys):
        trie.insert(key, i)
    first = {k: keys.index(k) for k in keys}
    assert sorted(trie.terminals()) == sorted((k, first[k], n) for k, n in Counter(keys).items())


def expected_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").encode().lower()].append(doc_id)
    out = []
    for key, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(key).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def test_exact_dedup(odd_docs, no_docs, documents, texts):
    got = sorted(map(tuple, exact_dedup(odd_docs).collect()), key=repr)
    assert got == expected_groups((r[0], r[1]) for r in ROWS)
    assert exact_dedup(no_docs).collect() == []
    whole = expected_groups(texts)
    assert sorted(map(tuple, exact_dedup(documents).collect()), key=repr) == whole
    # Tries that spill after every few texts give the same groups.
    assert sorted(map(tuple, exact_dedup(documents, trie_bytes=3000).collect()), key=repr) == whole


def test_exact_dedup_of_one_hot_text(spark):
    hot = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'Same Text', concat('t', id)) AS text")
    kept = exact_dedup(hot).where("kept")
    assert kept.count() == 2001 and kept.where("group_size = 1000").first().doc_id == 2997


def expected_components(fps):
    ids = list(fps)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(ids, 2):
        if (fps[a] ^ fps[b]).bit_count() <= 3:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: find(i) for i in ids}


def test_simhash_components(documents, texts):
    fps = {i: text_fingerprint(t.encode()) for i, t in texts}
    want = expected_components(fps)
    for chunk in (256, 1):
        got = simhash_components(documents, chunk_entries=chunk).collect()
        assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{fps[i]:016x}", want[i]) for i in fps}


def test_simhash_defined_cases(odd_docs, no_docs):
    rows = simhash_components(odd_docs).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(ROWS) and by_id[1].fingerprint == "0" * 16 and by_id[2].component_id == 1
    assert by_id[4].component_id == 3 and by_id[None].component_id is None
    assert simhash_components(no_docs).collect() == []
    assert text_fingerprint(b"one two") == text_fingerprint(b" ONE\ttwo\n")


def test_fingerprint_is_the_majority_of_sparks_own_hashes(spark):
    words = "a b c d e f g".split()
    shingles = [" ".join(words[i:i + 3]) for i in range(5)]
    hashes = [r[0] % (1 << 64) for r in spark.createDataFrame([(s,) for s in shingles], "s string").selectExpr("xxhash64(s)").collect()]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert text_fingerprint(" ".join(words).encode()) == want


def test_links_of_a_large_family(spark):
    """Many fingerprints around one centre: all are connected, and few links leave a task."""
    rng = random.Random(5)
    centre = 0x0123456789ABCDEF
    family = {centre} | {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(800)}
    far = {rng.getrandbits(63) for _ in range(50)}
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in family | far]
    found = links(spark.createDataFrame(signed, "fp long"), chunk_entries=16)
    labels = connected_components(found)
    assert labels.count() == len(family) and labels.select("label").distinct().count() == 1
    assert found.count() < 20 * len(family)


def test_connected_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (5, 4)]
    rows = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.label for r in rows} == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def brute_repeats(texts, match):
    counts = Counter(t[i:i + match] for t in texts for i in range(len(t) - match + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - match + 1):
            if counts[t[i:i + match]] > 1:
                gone[i:i + match] = True
        runs = int((np.diff(np.concatenate(([False], gone)).astype(int)) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab\x00ÿ", max_size=80), st.sampled_from([8, 12, 40]))
def test_two_stage_order_sorts_suffixes(text, depth):
    text = text.encode("latin-1")
    order = suffix_dedup.two_stage_order(text, depth).tolist()
    keys = [(text + bytes(depth))[i:i + depth] for i in order]
    assert sorted(order) == list(range(len(text))) and keys == sorted(keys)


def test_remove_repeats_against_brute_force(spark):
    rng = random.Random(11)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(300))
    rows = []
    for i in range(60):
        own = "".join(rng.choice("abcdefgh é") for _ in range(rng.randrange(0, 400)))
        cut = rng.randrange(0, 200)
        rows.append((i, own[:cut] + (passage[rng.randrange(60):] if i % 3 else passage) + own[cut:]))
    rows += [(60, "x" * 500), (61, rows[0][1]), (61, rows[0][1]), (62, None), (None, rows[3][1] + "z")]
    want = brute_repeats([(t or "").encode() for _, t in rows], 100)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for hot in (512, 2):
        got = suffix_dedup.remove_repeats(docs, match=100, gram=16, hot_segments=hot, sort_bytes=5000).collect()
        key = lambda r: (str(r[0]), r[1:])
        assert sorted((tuple(r) for r in got), key=key) == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=key)


def test_remove_repeats_defined_cases(odd_docs, no_docs, documents, texts):
    rows = suffix_dedup.remove_repeats(odd_docs).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(ROWS) and by_id[1].n_bytes == 0 and by_id[8].n_removed > 14_000
    assert by_id[9].n_removed == 630 and by_id[9].n_spans == 1
    assert suffix_dedup.remove_repeats(no_docs).collect() == []
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeats(documents).collect()}
    assert got == dict(zip([i for i, _ in texts], brute_repeats([t.encode() for _, t in texts], 400)))
