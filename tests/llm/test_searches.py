"""Hard negatives, source divergence and decontamination against plain Python and the registered SQL."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidefold.llm.decontamination import build_index, choose_keys, count_shingles, decontaminate, occurrences, words_of
from tidefold.llm.divergence import frequent_terms, source_divergence
from tidefold.llm.hard_negatives import hard_negatives, inner_products, least_score
from tidefold.llm.queries import ORACLES, QUERIES


def _sql(sf_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        connection.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    found = connection.execute(ORACLES[name])
    names = [c[0] for c in found.description]
    return sorted(tuple(sorted(zip(names, r))) for r in found.fetchall())


def _rows(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_source_divergence", "op13_decontamination"])
def test_query_equals_sql(spark, sf_dir, name):
    assert _rows(QUERIES[name](spark, sf_dir)) == sorted(_sql(sf_dir, name), key=repr)


# --- hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, key string, score int, windows string, rows string"


def _mined(rows, n_pos=5, n_neg=5):
    """The contract, anchor by anchor in plain Python."""
    fine = [
        (at, i, label, [math.floor(256 * x) for x in vector]) for at, (i, vector, label) in enumerate(rows)
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    out = []
    for at, i, label, vector in fine:
        if i is None or i % 100:
            continue
        scored = [(-sum(p * q for p, q in zip(vector, v)), j is None, j or 0, b, lab) for b, j, lab, v in fine if b != at]
        scored.sort(key=lambda s: s[:3])
        for score, no_id, j, _, _ in [s for s in scored if s[4] == label][:n_pos]:
            near = [s for s in scored if s[4] != label and 80 * -score <= 100 * -s[0] <= 100 * -score]
            out += [(i, None if no_id else j, rank, None if s[1] else s[2], -score, -s[0]) for rank, s in enumerate(near[:n_neg], 1)]
    return sorted(out, key=repr)


def _odd_vectors():
    rng = random.Random(5)
    rows = [(i, [round(rng.gauss(0.2, 0.5), 2) for _ in range(6)], rng.randrange(3)) for i in range(230)]
    rows += [(None, rows[7][1], 0), (None, rows[100][1], 1), (100, rows[3][1], 1), (100, rows[3][1], 1), (500, [0.3] * 6, 2)]
    rows += [(600 + i, [0.5] * 6, i % 2) for i in range(60)]  # one vector, very common
    rows += [(700, None, 1), (800, [1.0, None, 0.0], 1), (900, [float("nan")] * 6, 0), (901, [float("inf")] * 6, 0)]
    return rows + [(1000, [0.1] * 6, None), (1100, [0.4, 0.4], 1), (1101, [], 1), (1200, [], 0), (1300, [-0.2] * 9, 2), (-100, [0.3] * 6, 0)]


def test_odd_vectors_equal_brute_force(spark):
    rows = _odd_vectors()
    df = spark.createDataFrame([(*r, "k", 1, "w", "r") for r in rows], VECTORS).repartition(3)
    for sizes in ({}, {"row_values": 40, "anchor_values": 12}):
        found = hard_negatives(df, F.col("vec_id") % 100 == 0, **sizes)
        assert sorted((tuple(r) for r in found.collect()), key=repr) == _mined(rows)
    assert {r[0] for r in _mined(rows)} >= {0, 100, 200, 500, 600}


def test_no_vectors_and_no_anchors(spark):
    df = spark.createDataFrame([(1, [0.5], 1, "k", 1, "w", "r"), (2, [0.5], 2, "k", 1, "w", "r")], VECTORS)
    assert hard_negatives(df.where("false"), F.col("vec_id") % 100 == 0).count() == 0
    assert hard_negatives(df, F.col("vec_id") % 100 == 0).count() == 0


def test_scores_are_exact():
    one, two = np.array([[1e12, 0.3], [-1e300, 2.0]]), np.array([[1e12 + 0.25, -0.001], [1e300, 1.0]])
    whole = [[[math.floor(256 * v) for v in row] for row in m.tolist()] for m in (one, two)]
    top, low = 2**63 - 1, -(2**63)
    wanted = [[max(low, min(top, sum(a * b for a, b in zip(r, s)))) for s in whole[1]] for r in whole[0]]
    assert inner_products(one, two).tolist() == wanted
    small = np.array([[0.5, -0.3]]), np.array([[0.25, 0.75, 4.0]])
    assert inner_products(*small).tolist() == [[128 * 64 + math.floor(-0.3 * 256) * 192]]
    assert [least_score(s) for s in (10, 11, 0, -10)] == [8, 9, 0, -8]


# --- divergence

DOCS = "doc_id long, text string, lang string, source string, term string, n string, total string, block string, side string, item string"


def _divergence(rows, least, top):
    docs = [(lang or "", source or "", [
        "".join(c.lower() if c.isascii() else c for c in t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    ]) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        kept = sorted(t for t, n in Counter(t for d in mine for t in set(d[2])).items() if n >= least)
        counts = {s: Counter() for s in {d[1] for d in mine}}
        for _, source, terms in mine:
            counts[source].update(t for t in terms if t in set(kept))
        whole = sum(counts.values(), Counter())

        def share(of, term):
            return 1 + 10**9 * (of[term] + 5) // (sum(of.values()) + 5 * len(kept))

        for s in counts:
            pairs = [(-sum(abs(share(counts[s], t) - share(counts[o], t)) for t in kept), o.encode(), o) for o in counts if o != s]
            terms = [(share(whole, t) - share(counts[s], t), t.encode(), t) for t in kept if counts[s][t]]
            terms = [t for t in terms if t[0] < 0]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -value, rank) for rank, (value, _, item) in enumerate(found, 1)]
    return sorted(out)


def _odd_texts():
    rng = random.Random(6)
    words = ["Zug", "zug", "a", "ab", "abc", "abcd", "abcde", "ÄPFEL", "äpfel", "日本語日本語日本語", "x" * 40, "x" * 40 + "y", "naïve"]
    rows = [(i, " 7,".join(rng.choices(words, k=rng.randrange(0, 9))), rng.choice(["en", "en", "de", None, ""]), rng.choice(["s1", "s2", "Ä", None, "s10"])) for i in range(160)]
    rows += [(1, "rare " * 50, "xx", "only"), (1, "rare", "xx", "only"), (None, None, "yy", "a"), (None, "", "yy", "b"), (5, "!!! 123", "yy", "c")]
    return rows + [(200 + i, "hot " * (i + 1) + "unique%s" % chr(97 + i), "en", "s1") for i in range(20)] + [(300, "z" * 100_000, "en", "s2")]


def test_divergence_equals_brute_force(spark):
    rows = _odd_texts()
    df = spark.createDataFrame([(*r, *"tntbsi") for r in rows], DOCS).repartition(5)
    for least, sizes in ((3, {}), (10, {"tile_sources": 2, "tile_terms": 3, "first_level": 1, "top_terms": 2})):
        got = sorted(tuple(r) for r in source_divergence(df, min_documents=least, **sizes).collect())
        assert got == _divergence(rows, least, sizes.get("top_terms", 50))
    assert source_divergence(df.where("false")).count() == 0


def test_refinement_ends_at_the_longest_frequent_prefix(spark):
    long = "ab" * 500
    rows = [("en", "s", b"q " + long.encode() + b" ", b""), ("en", "s", long.encode() + b"c ", b""), ("en", "t", b"q qq ", b""), ("de", "s", b"q ", b"")]
    df = spark.createDataFrame(rows, "lang string, source string, terms binary, counts binary")
    assert sorted((r.lang, bytes(r.prefix)) for r in frequent_terms(df, 2).collect()) == [("en", b"q")]
    assert len(frequent_terms(df, 1).collect()) == 5


# --- decontamination

def _plain_words(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return words


def _leaks(docs, items):
    windows = {}
    for item, text in items:
        words = _plain_words(text)
        size = min(10, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i:i + size]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        words, hit, found = _plain_words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if named := windows.get(tuple(words[i:i + size])):
                    hit.update(range(i, i + size))
                    found |= named
        out.append((doc_id, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def _odd_leaks():
    rng = random.Random(7)
    words = ["the", "of", "Größe", "x1", "2024", "w" * 70, "w" * 69 + "v", "q", "日本"]
    passages = [" ".join(rng.choices(words, k=rng.randrange(1, 30))) for _ in range(25)]
    items = [(i, p) for i, p in enumerate(passages)] + [(3, "a second row of item three with more than ten words in it, indeed")]
    items += [(None, "no identifier but words enough to make a window or two of ten"), (90, None), (91, "..."), (92, ""), (93, "Zebra"), (94, "the of")]
    items += [(95, passages[4].upper()), (96, "the " * 40)]
    docs = [(i, " ; ".join(rng.choices([*passages, "filler text", "zebra!", "the of", "the"], k=rng.randrange(0, 6)))) for i in range(80)]
    docs += [(7, docs[7][1]), (None, passages[3]), (None, None), (101, ""), (102, "the " * 5000), (103, "a Second row of ITEM three-with more than ten words")]
    return docs + [(104, "row of item three with more than ten words in"), (105, "x" * 1000), (106, "word " * 9)], items


def test_leaks_equal_brute_force(spark):
    docs, items = _odd_leaks()
    extra = "n_words string, sha string, window string, klass string, item string, runs string"
    frame = spark.createDataFrame([(*d, *"abcdef") for d in docs], f"doc_id long, text string, {extra}").repartition(4)
    bench = spark.createDataFrame([(*i, *"abcdef") for i in items], f"item_id long, text string, {extra}")
    for sizes in ({}, {"block_windows": 120}, {"shingle_words": 1}):
        got = [tuple(r) for r in decontaminate(spark, frame, bench, **sizes).collect()]
        assert sorted(got, key=repr) == _leaks(docs, items)
    assert decontaminate(spark, frame.where("false"), bench).count() == 0
    clean = decontaminate(spark, frame, bench.where("false")).collect()
    assert len(clean) == len(docs) and not any(r.contaminated or r.n_hit or r.n_items for r in clean)


def test_only_the_rarest_shingle_is_looked_up():
    windows = [(b"a b c d e f g h i j", "1"), (b"b c d e f g h i j k", "1"), (b"never seen here at all a b c d e", "2")]
    index = build_index(windows, 10, 3)
    counts = {size: np.zeros(len(known), np.int64) for size, known in index.shingles.items()}
    text = words_of(b"a b c " * 50 + b"a b c d e f g h i j k")
    count_shingles(index, text, counts)
    choose_keys(index, counts, 3)
    keys, _, of, _ = index.keys[3]
    assert sorted(of.tolist()) == [0, 1] and counts[3][np.searchsorted(index.shingles[3], keys)].tolist() == [1] * len(keys)
    found = [(s, w) for start, window in occurrences(index, text) for s, w in zip(start.tolist(), window.tolist())]
    assert sorted(found) == [(150, 0), (151, 1)]
