"""Mixing, quotation linking, toxicity, weak supervision and the pipeline."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import pyspark.sql.functions as F
import pytest

import corpus_pipeline
from tests.llm.conftest import ROWS
from tidefold.llm.mixing import mix, poisson_table, source_rates
from tidefold.llm.quotes import link_quotes, parse_passages
from tidefold.llm.toxicity import toxicity
from tidefold.llm.weak_rules import fit_votes, posterior, weak_quality


def test_poisson_table(spark):
    rates = spark.createDataFrame([("a", 0.3), ("b", 40.0), (None, 1.0)], "mix_source string, rate double")
    for row in poisson_table(rates).collect():
        rate = {"a": 0.3, "b": 40.0, None: 1.0}[row.mix_source]
        total = 0.0
        for k, value in enumerate(row.cdf):
            total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
            assert value == pytest.approx(total, abs=1e-12)
        assert row.cdf[-1] == pytest.approx(1.0, abs=1e-9)


def test_mix_reaches_its_targets(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'abc' AS text", "IF(id % 3 = 0, 'hot', concat('s', id % 20)) AS source")
    target = spark.createDataFrame([("hot", 1.0), ("s1", 3.0)], "source string, weight double")
    counts = dict(mix(docs, weights=target).groupBy("source").count().collect())
    assert set(counts) == {"hot", "s1"} and counts["hot"] == pytest.approx(5000, rel=0.05)
    assert counts["s1"] == pytest.approx(15_000, rel=0.05)
    again = mix(docs.repartition(7), weights=target).select("doc_id", "copy").collect()
    assert Counter(again) == Counter(mix(docs, weights=target).select("doc_id", "copy").collect())


def test_mix_defined_cases(odd_docs, no_docs):
    out = mix(odd_docs, epochs=50.0)
    assert set(out.columns) == {*odd_docs.columns, "mix_key"}
    rows = out.collect()
    assert {r.doc_id for r in rows} == {r[0] for r in ROWS} and {r.source for r in rows} == {r[2] for r in ROWS}
    per_copy = Counter((r.doc_id, r.copy) for r in rows)
    assert all(n == (2 if i == 7 else 1) for (i, _), n in per_copy.items())
    assert mix(no_docs).collect() == [] and source_rates(no_docs).collect() == []


def test_parse_passages(spark):
    text = "> > deep\n>> deeper\n> one\n>one more\nown\nlines\n\n> end"
    got = spark.createDataFrame([(text,), ("",)], "t string").select(parse_passages(F.col("t")).alias("p")).collect()
    assert [(p.level, p.body) for p in got[0].p] == [(2, "deep\ndeeper"), (1, "one\none more"), (0, "own\nlines\n"), (1, "end")]
    assert [(p.level, p.body) for p in got[1].p] == [(0, "")]


def test_link_quotes(spark):
    messages = spark.createDataFrame([
        (1, "Hello  there", "t", 0), (2, "> hello there\nYes?", "t", 0), (3, "> > Hello there\n> yes?\nNo.\nReally", "t", 0),
        (4, "> hello there\nAnother answer", "u", 0), (5, "> nobody said this\nalone", "t", 0), (6, None, None, 0),
        (7, "> \n> \n", None, 0), (None, "lost", "t", 0), (8, "> yes?\n> > hello there\nmixed\n> no.\n> really\nends", "t", 0),
        (8, "> zzz later text", "t", 0),
    ], "id long, text string, thread string, parent int")
    rows = {r.id: r for r in link_quotes(messages).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert [(rows[i].parent, rows[i].conversation, rows[i].depth) for i in (1, 2, 3, 4, 5, 6, 7, 8)] == [
        (None, 1, 0), (1, 1, 1), (2, 1, 2), (1, 1, 1), (None, 5, 0), (None, 6, 0), (None, 7, 0), (3, 1, 3)]
    assert rows[3].body == "No.\nReally" and rows[3].n_quoted == 2 and rows[8].body == "mixed\nends"
    assert rows[6].body == "" and link_quotes(messages.where("false")).collect() == []


def test_link_quotes_shared_passage(spark):
    """A passage that a third of all messages share gives each quotation one link."""
    same = spark.range(600).selectExpr("id", "IF(id % 3 = 0, 'the same', concat('> the same\n', id)) AS text", "'x' AS thread")
    rows = link_quotes(same).collect()
    assert len(rows) == 600 and {r.conversation for r in rows if r.id % 3} == {0} and max(r.depth for r in rows) == 1


def test_toxicity_on_held_out_rows(spark):
    words = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(1500):
        text = " ".join(words[(i * 7 + k * k) % 200] for k in range(30))
        toxic = i % 6 == 0
        rows.append((i, f"{text} {['Idiot!', 'STUPID', 'moron,'][i % 9 // 3]} {text}" if toxic else text))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scored = {r.doc_id: r for r in toxicity(docs, marks).collect()}
    held = [i for i in scored if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i in scored if scored[i].held_out} == set(held) and len(scored) == 1500
    right = sum(scored[i].predicted == int(i % 6 == 0) for i in held)
    assert right >= 0.98 * len(held) and all(0 <= r.score <= 1 for r in scored.values())
    # Labels of held-out rows teach nothing.
    flipped = marks.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {r.doc_id: r.score for r in toxicity(docs, flipped).collect()} == {i: r.score for i, r in scored.items()}


def test_toxicity_defined_cases(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(3, 0), (3, 1), (4, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    rows = toxicity(odd_docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 and r.predicted == 0 for r in toxicity(odd_docs, labels.where("false")).collect())
    assert toxicity(no_docs, labels).collect() == []


def base_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    covered = {w for at in windows.values() if len(at) > 1 for i in at for w in range(i, i + 8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def test_weak_quality_statistics(documents, texts, odd_docs, no_docs):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = {r.doc_id: tuple(r[n] for n in names) for r in weak_quality(documents).collect()}
    assert got == {i: base_statistics(t) for i, t in texts}
    rows = weak_quality(odd_docs).collect()
    want = Counter((str(r[0]), *base_statistics(r[1] or "")) for r in ROWS)
    assert Counter((str(r.doc_id), *(r[n] for n in names)) for r in rows) == want
    assert all(not r.kept for r in rows if r.base_failed) and weak_quality(no_docs).collect() == []


def test_weak_quality_agrees_with_labels(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    rows = weak_quality(documents).join(labels, "doc_id").where("NOT base_failed").collect()
    assert sum(r.kept == bool(r.label) for r in rows) >= 0.97 * len(rows)


def test_votes_are_fitted_by_expectation_maximisation(spark):
    """Against the same iteration in plain Python."""
    patterns = [(1, 1, 0, 500), (1, 0, 1, 300), (-1, -1, 0, 120), (-1, 1, -1, 60), (1, -1, 1, 40), (0, 0, 0, 10)]
    rules = ["a", "b", "c"]
    share, right = fit_votes(spark.createDataFrame(patterns, "a int, b int, c int, n long"), rules, 10)
    q = [0.1 if -1 in p[:3] else 0.9 for p in patterns]
    for _ in range(10):
        s = (sum(p[3] * x for p, x in zip(patterns, q)) + 1) / (sum(p[3] for p in patterns) + 2)
        on = []
        for j in range(3):
            count = lambda v, w: sum(p[3] * (x if w else 1 - x) for p, x in zip(patterns, q) if p[j] == v)  # noqa: B023, E731
            on.append(((count(1, 1) + 1) / (count(1, 1) + count(-1, 1) + 2), (count(-1, 0) + 1) / (count(1, 0) + count(-1, 0) + 2)))
        q = []
        for p in patterns:
            odds = math.log(s / (1 - s))
            for j in range(3):
                odds += {1: math.log(on[j][0] / (1 - on[j][1])), -1: math.log((1 - on[j][0]) / on[j][1]), 0: 0.0}[p[j]]
            q.append(1 / (1 + math.exp(-odds)))
    assert share == pytest.approx(s) and [right[r] for r in rules] == [pytest.approx(x) for x in on]
    got = spark.createDataFrame(patterns, "a int, b int, c int, n long").select(posterior(share, right).alias("q")).collect()
    assert [r.q for r in got] == pytest.approx(q)


def test_pipeline_stages(spark, documents, odd_docs, no_docs, sf_dir):
    docs = documents
    kept = {"start": docs.count()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        docs = out.cache()
        kept[name] = docs.count()
        if name == "toxicity":
            clean = [r.text.encode().lower() for r in docs.select("text").collect()]
    assert kept["start"] > kept["toxicity"] and kept["exact_dedup"] == len(set(clean)) >= kept["simhash_near_dedup"]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id", "piece").where("piece = 0").count() == docs.count()
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd_docs, sf_dir).count() > 0, name
        assert stage(spark, no_docs, sf_dir).collect() == [], name


def test_pipeline_keeps_one_of_each_group(spark, sf_dir):
    rows = [(i, f"{'Copy' if i < 3 else f'text number {i} with words'} of it", "en", "s", 9) for i in range(8)]
    rows.append((2, "COPY OF IT", "en", "s", 9))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_exact_copies(spark, docs, sf_dir)
    assert sorted({r.doc_id for r in kept.collect()}) == [2, 3, 4, 5, 6, 7]
