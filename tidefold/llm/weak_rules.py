"""Quality rules by weak supervision.

Every rule looks at one statistic of a document and votes good, votes bad or abstains. Nobody
says which rule is right: expectation-maximisation finds, for good and for bad documents, how
often each rule's vote is correct, and from that the probability that a document is good. A
document stays if this probability is at least a half; no single rule decides.

Everything is DataFrame code. Statistics are computed within a document's row; the iterations
run over counts of vote patterns, at most three to the power of the number of rules, so their
cost does not depend on the size of the corpus, and their result on all of it.

Defined cases: a null text has no words; a text without words fails the base rule and all
rules that need words abstain; rows that repeat an identifier are judged one by one; a null
identifier stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import BLANK_RUN, BLANKS, let, materialise

WINDOW_WORDS = 8
SYMBOLS = r"[#*$%&|<>]+"
ITERATIONS = 20
SMOOTHING = 1.0
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


def _dup_lines(body: Column) -> Column:
    lines = F.filter(F.split(body, "\n"), lambda line: F.length(F.btrim(line, F.lit(BLANKS))) > 0)
    return let(lines, lambda v: F.struct(
        F.size(v).cast("long").alias("n_lines"),
        (F.size(v) - F.size(F.array_distinct(v))).cast("long").alias("n_dup_lines"),
    ))


def _covered(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more; `hashes` is a bound variable."""
    numbered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(pairs: Column) -> Column:
        marked = F.transform(pairs, lambda p, k: F.when(
            (p["h"] == F.get(pairs, k - 1)["h"]) | (p["h"] == F.get(pairs, k + 1)["h"]), p["i"]
        ))
        return F.array_sort(F.filter(marked, lambda i: i.isNotNull()))

    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(
        let(numbered, repeated), start,
        lambda acc, i: F.struct(
            (i + WINDOW_WORDS).alias("end"),
            (acc["total"] + F.least(F.lit(WINDOW_WORDS), i + WINDOW_WORDS - acc["end"])).alias("total"),
        ),
        lambda acc: acc["total"],
    )


def _repeat_words(words: Column) -> Column:
    """Words in windows found twice or more; `words` is a bound variable."""
    windows = F.when(
        F.size(words) >= WINDOW_WORDS,
        F.transform(
            F.sequence(F.lit(1), F.size(words) - (WINDOW_WORDS - 1)),
            lambda i: F.xxhash64(F.slice(words, i, WINDOW_WORDS)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    # Most texts repeat nothing, and a set of hashes tells; only the others are sorted.
    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_covered(h)))


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id and the counts the rules need, over the whole text."""
    body = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    words = F.filter(F.split(body, BLANK_RUN), lambda w: w != "")
    upper = F.length(F.regexp_replace(body, r"[^\p{Lu}]+", ""))
    counts = let(words, lambda v: F.struct(
        F.size(v).cast("long").alias("n_words"),
        F.aggregate(v, F.lit(0).cast("long"), lambda total, w: total + F.length(w)).alias("word_chars"),
        _repeat_words(v).alias("n_repeat_words"),
        F.size(F.array_distinct(v)).cast("long").alias("n_distinct"),
        F.size(F.filter(v, lambda w: w.rlike(SYMBOLS))).cast("long").alias("n_symbol_words"),
        F.aggregate(
            v, F.struct(F.lit("").alias("last"), F.lit(0).cast("long").alias("n")),
            lambda acc, w: F.struct(w.alias("last"), (acc["n"] + (acc["last"] == w).cast("long")).alias("n")),
            lambda acc: acc["n"],
        ).alias("n_stutters"),
    ))
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), counts.alias("c"), _dup_lines(body).alias("l"),
        (F.length(body) - F.length(F.regexp_replace(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        upper.cast("long").alias("n_upper"),
        F.length(F.regexp_replace(body, r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
    ).select(
        "doc_id", "c.n_words", "c.word_chars", "n_symbols", "l.n_dup_lines", "c.n_repeat_words",
        "l.n_lines", "c.n_distinct", "c.n_stutters", "c.n_symbol_words",
        "n_upper", "n_letters",
    )


def _vote(bad: Column, good: Column) -> Column:
    """-1 bad, 1 good, 0 abstains; a rule without words to look at abstains."""
    return F.when(F.col("n_words") == 0, 0).when(bad, -1).when(good, 1).otherwise(0)


def rule_votes() -> dict[str, Column]:
    """Name of each rule and its vote, over the columns of `text_statistics`."""
    words, chars = F.col("n_words"), F.col("word_chars")
    mean = chars / words
    symbols = F.col("n_symbols") / words
    dup_lines = F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))
    repeats = F.col("n_repeat_words") / words
    distinct = F.col("n_distinct") / words
    stutters = F.col("n_stutters") / words
    upper = F.col("n_upper") / F.greatest(chars, F.lit(1))
    letters = F.col("n_letters") / F.greatest(chars, F.lit(1))
    symbol_words = F.col("n_symbol_words") / words
    return {
        "length": _vote(words < MIN_WORDS, words >= 50),
        "word_length": _vote((mean < 2) | (mean > 15), (mean >= 3) & (mean <= 11)),
        "symbols": _vote(symbols > 0.2, symbols < 0.02),
        "symbol_words": _vote(symbol_words > 0.2, symbol_words < 0.02),
        "letters": _vote(letters < 0.88, letters > 0.93),
        "lines": _vote(dup_lines > 0.4, dup_lines < 0.1),
        "windows": _vote(repeats > 0.3, repeats < 0.05),
        "vocabulary": _vote(distinct < 0.15, distinct > 0.3),
        "stutter": _vote(stutters > 0.15, stutters < 0.05),
        "capitals": _vote(upper > 0.5, upper < 0.2),
    }


def fit_votes(patterns: DataFrame, rules: list[str], iterations: int = ITERATIONS) -> tuple[float, dict[str, tuple[float, float]]]:
    """Share of good documents, and per rule how often its vote is right on good and on bad ones.

    `patterns` has a column per rule and `n`. The start takes a document with any bad vote for
    bad. An iteration is one aggregation; only its sums, two per rule and outcome, come back.
    """
    any_bad = F.greatest(*[(F.col(r) == -1).cast("int") for r in rules]) == 1
    quality: Column = F.when(any_bad, 0.1).otherwise(0.9)
    share, right = 0.5, {r: (0.7, 0.7) for r in rules}
    for _ in range(iterations):
        good, bad = F.col("n") * F.col("q"), F.col("n") * (1 - F.col("q"))
        sums = [F.sum(good).alias("good"), F.sum("n").alias("all")]
        for i, r in enumerate(rules):
            for vote, side in ((1, "up"), (-1, "down")):
                cast = F.col(r) == vote
                sums += [F.sum(F.when(cast, good)).alias(f"good_{side}_{i}"), F.sum(F.when(cast, bad)).alias(f"bad_{side}_{i}")]
        total = {k: v or 0.0 for k, v in patterns.withColumn("q", quality).agg(*sums).first().asDict().items()}
        s = SMOOTHING
        share = (total["good"] + s) / (total["all"] + 2 * s)
        right = {
            r: (
                (total[f"good_up_{i}"] + s) / (total[f"good_up_{i}"] + total[f"good_down_{i}"] + 2 * s),
                (total[f"bad_down_{i}"] + s) / (total[f"bad_up_{i}"] + total[f"bad_down_{i}"] + 2 * s),
            )
            for i, r in enumerate(rules)
        }
        quality = posterior(share, right)
    return share, right


def posterior(share: float, right: dict[str, tuple[float, float]]) -> Column:
    """Probability of good, given the votes; abstaining rules say nothing."""
    odds: Column = F.lit(math.log(share / (1 - share)))
    for r, (on_good, on_bad) in right.items():
        odds = odds + F.when(F.col(r) == 1, math.log(on_good / (1 - on_bad))).when(
            F.col(r) == -1, math.log((1 - on_good) / on_bad)
        ).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def weak_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", iterations: int = ITERATIONS) -> DataFrame:
    """One row per document: doc_id, the statistics, base_failed, quality (probability), kept."""
    votes = rule_votes()
    judged = materialise(
        text_statistics(docs, id_col, text_col).select("*", *[v.cast("int").alias(f"vote_{r}") for r, v in votes.items()]),
        "weak-votes",
    )
    names = [f"vote_{r}" for r in votes]
    patterns = materialise(judged.groupBy(*names).agg(F.count("*").alias("n")), "weak-patterns")
    share, right = fit_votes(patterns, names, iterations)
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), posterior(share, right).alias("quality"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
