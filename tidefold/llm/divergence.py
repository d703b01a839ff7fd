"""How the words of each source differ from those of its language.

Which terms are frequent enough is found by iceberg refinement of byte prefixes. A term is in a
document only if each of its prefixes is, so a prefix in too few distinct documents of a language
has no kept term below it. Level by level the prefixes grow (to 4, 8, 16, ... bytes): each level
counts, per language, the documents that hold an extension of a prefix that survived, and drops
what falls below the threshold. A term that ends within a level is complete, and kept if its own
count suffices; the refinement ends when no open prefix is left, after as many levels as the
longest frequent prefix needs. Most of the vocabulary of a large corpus occurs once or twice; it
goes at short prefixes, of which there are few.

Documents are split into distinct terms with counts once, in a written table in which those of
one language and source lie together, so that a task's sums are few; a hot source is many tasks.
Tasks know what survived from a bitmap of fixed size, whatever the number of survivors: a prefix
that passes by chance cannot reach the threshold, and occurrences are joined with the kept terms.
Shares are whole numbers and all arithmetic is exact. Pairs of sources are compared in tiles: a
task holds a bounded number of sources and, in expectation, of terms, and adds up absolute
differences.

Defined cases: null texts, languages and sources count as ''; a text without terms still makes
its (language, source) a group; rows that repeat an identifier are documents of their own; ties
in value go by the item's UTF-8 bytes; a language without kept terms has pairs of value 0 and no
terms; a language with one source has no pairs; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefold.llm.common import materialise, utf8
from tidefold.session import broadcast_if_bounded

MIN_DOCUMENTS = 30
FIRST_LEVEL = 4
SHARE_SCALE = 1_000_000_000
SMOOTHING = 5
TOP_TERMS = 50
TILE_SOURCES = 128
TILE_TERMS = 2048
# The bitmap of what survived, what a task looks at at once, and sums that it holds.
FILTER_BITS = 1 << 25
SLICE_BYTES = 1 << 22
SUMMED_ROWS = 1 << 20

# Letters of terms, A-Z already in lower case: every byte of a character beyond ASCII is one.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """The terms of one whole text, repeats included."""
    return text.translate(_LETTERS).split()


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct terms in byte order, each followed by a blank, and their counts as 32-bit numbers."""
    for batch in batches:
        blobs, counts = [], []
        for text in batch.column(2):
            found = Counter(terms_of(text.as_py()))
            terms = sorted(found)
            blobs.append(b" ".join([*terms, b""]))
            counts.append(np.fromiter(map(found.get, terms), "<i4", len(terms)).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(blobs, pa.binary()), pa.array(counts, pa.binary())],
            names=["lang", "source", "terms", "counts"],
        )


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, at most SLICE_BYTES of terms at a time unless one document has more."""
    for batch in batches:
        ends = np.cumsum(pa.compute.binary_length(batch.column(2)).to_numpy())
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            n = max(1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")) - at)
            yield batch.slice(at, n)
            at += n


@dataclass
class Terms:
    """The terms of some documents as places in one buffer: `docs` and `langs` number what each is of."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    docs: np.ndarray
    langs: np.ndarray
    names: list[str]

    def take(self, chosen: np.ndarray) -> Terms:
        return replace(self, **{name: getattr(self, name)[chosen] for name in ("starts", "lengths", "docs", "langs")})


def _terms(batch: pa.RecordBatch) -> Terms:
    """Terms of a batch, the blank at its end being part of each."""
    blobs = batch.column(2)
    data = np.frombuffer(b"".join(blobs.to_pylist()) + bytes(8), np.uint8)
    ends = np.flatnonzero(data == 0x20) + 1
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    docs = np.searchsorted(np.cumsum(pa.compute.binary_length(blobs).to_numpy()), starts, side="right")
    langs, names = _coded(batch.column(0))
    return Terms(data, starts, ends - starts, docs, langs[docs], names)


def _coded(column: pa.Array) -> tuple[np.ndarray, list]:
    """Codes of the values, and the values by code."""
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def _words(terms: Terms, at: int, lengths: np.ndarray) -> np.ndarray:
    """Bytes `at` to `at + 8` of each term as one number, zeros beyond `lengths`."""
    words = np.zeros(len(lengths), np.uint64)
    for byte in range(8):
        there = at + byte < lengths
        if not there.any():
            break
        words |= np.where(there, terms.data[np.where(there, terms.starts + (at + byte), 0)], 0).astype(np.uint64) << np.uint64(56 - 8 * byte)
    return words


def _hashes(terms: Terms, lengths: np.ndarray) -> np.ndarray:
    """A place in the bitmap for (language, first `lengths` bytes) of each term."""
    names = np.array([xxhash.xxh64_intdigest(name.encode()) for name in terms.names], np.uint64)
    hashes = names[terms.langs]
    at, left = 0, np.arange(len(lengths))
    while len(left):
        some = terms.take(left)
        mixed = (hashes[left] ^ _words(some, at, lengths[left])) * np.uint64(0x9E3779B97F4A7C15)
        hashes[left] = mixed ^ (mixed >> np.uint64(29))
        at += 8
        left = left[lengths[left] > at]
    return hashes & np.uint64(FILTER_BITS - 1)


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Bits of `keys(lang, prefix)`, collected as at most FILTER_BITS / 64 numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column(1).to_pylist()
            lengths = np.array([len(b) for b in blobs], np.int64)
            langs, names = _coded(batch.column(0))
            starts = np.cumsum(lengths) - lengths
            at = _hashes(Terms(np.frombuffer(b"".join(blobs) + bytes(8), np.uint8), starts, lengths, langs, langs, names), lengths)
            bits = (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(bits)], names=["place", "bits"])

    rows = keys.select("lang", "prefix").mapInArrow(run, "place long, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).collect()
    words = np.zeros(FILTER_BITS // 64, np.int64)
    words[[r.place for r in rows]] = [r.bits for r in rows]
    return words.view(np.uint64)


def _known(bitmap: np.ndarray, terms: Terms, lengths: np.ndarray) -> np.ndarray:
    at = _hashes(terms, lengths)
    return (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def _binary(terms: Terms, lengths: np.ndarray) -> pa.Array:
    """The first `lengths` bytes of each term."""
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    places = np.arange(offsets[-1]) + np.repeat(terms.starts - offsets[:-1], lengths)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(terms.data[places])])


def _summed(parts: Iterator[pa.Table], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Sums of n by `keys` over many small tables, passed on whenever SUMMED_ROWS are held."""
    held, n = [], 0

    def total() -> pa.Table:
        return pa.concat_tables(held).group_by(keys, use_threads=False).aggregate([("n", "sum")]).rename_columns([*keys, "n"])

    for part in parts:
        held.append(part.group_by(keys, use_threads=False).aggregate([("n", "sum")]).rename_columns([*keys, "n"]))
        n += held[-1].num_rows
        if n >= SUMMED_ROWS:
            held = [total()]
            n = held[0].num_rows
            if n >= SUMMED_ROWS // 2:
                yield from held.pop().to_batches()
                n = 0
    if held:
        yield from total().to_batches()


def _extensions(below: int, level: int, alive):
    """Rows (lang, prefix, n): documents with a term that goes beyond an open prefix of `below` bytes,
    by its first `level` bytes."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for batch in _slices(batches):
            terms = _terms(batch)
            if alive is not None:
                terms = terms.take(np.flatnonzero(terms.lengths > below))
                terms = terms.take(np.flatnonzero(_known(alive.value, terms, np.full(len(terms.starts), below))))
            lengths = np.minimum(terms.lengths, level)
            # Terms of a document are in order, so those with a prefix in common are neighbours.
            new = np.ones(len(lengths), bool)
            new[1:] = (terms.docs[1:] != terms.docs[:-1]) | (lengths[1:] != lengths[:-1])
            for at in range(0, level, 8):
                words = _words(terms, at, lengths)
                new[1:] |= words[1:] != words[:-1]
            terms, lengths = terms.take(np.flatnonzero(new)), lengths[new]
            names = pa.array(terms.names, pa.string()).take(pa.array(terms.langs))
            yield pa.table({"lang": names, "prefix": _binary(terms, lengths), "n": np.ones(len(lengths), np.int64)})

    return lambda batches: _summed(parts(batches), ["lang", "prefix"])


def _occurrences(kept):
    """Rows (lang, source, term, n) for terms that may be kept."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for batch in _slices(batches):
            terms = _terms(batch)
            counts = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<i4")
            chosen = np.flatnonzero(_known(kept.value, terms, terms.lengths - 1))
            terms, counts = terms.take(chosen), counts[chosen]
            yield pa.table({
                "lang": pa.array(terms.names, pa.string()).take(pa.array(terms.langs)), "source": batch.column(1).take(pa.array(terms.docs)),
                "term": _binary(terms, terms.lengths - 1), "n": counts.astype(np.int64),
            })

    return lambda batches: _summed(parts(batches), ["lang", "source", "term"])


def frequent_terms(documents: DataFrame, min_documents: int = MIN_DOCUMENTS, first_level: int = FIRST_LEVEL) -> DataFrame:
    """Rows (lang, prefix): the terms in at least `min_documents` of `documents(lang, source, terms, counts)` of a language."""
    context = documents.sparkSession.sparkContext
    below, level, alive, kept = 0, first_level, None, []
    ends = F.substring("prefix", -1, 1) == F.lit(b" ")
    while True:
        found = documents.mapInArrow(_extensions(below, level, alive), "lang string, prefix binary, n long")
        counted = found.groupBy("lang", "prefix").agg(F.sum("n").alias("n")).where(F.col("n") >= min_documents)
        counted = materialise(counted.select("lang", "prefix", ends.alias("complete")), "divergence-prefixes")
        kept.append(counted.where("complete").select("lang", F.expr("substring(prefix, 1, length(prefix) - 1)").alias("prefix")))
        bits = _bitmap(counted.where("NOT complete"))
        if not bits.any():
            break
        alive, below, level = context.broadcast(bits), level, 2 * level
    whole = kept[0]
    for more in kept[1:]:
        whole = whole.union(more)
    return materialise(whole, "divergence-terms")


def _share(count: Column, total: Column, n_terms: Column) -> Column:
    """1 + floor(SHARE_SCALE * (count + SMOOTHING) / (total + SMOOTHING * n_terms)), exact."""
    over = (F.lit(SHARE_SCALE).cast("decimal(10,0)") * (count + SMOOTHING).cast("decimal(20,0)")).alias("over")
    under = (total + SMOOTHING * n_terms).cast("decimal(20,0)")
    return F.call_function("div", over, under) + F.lit(1)


def _tile_differences(rows: pa.Table) -> pa.Table:
    """Sums over the terms of a tile of |p - q|, for sources of its one side against those of its other.

    Rows without a term name the sources, with all kept terms of the tile as `n`; `side` is 1 and 2
    for the two sides, 3 for both. Terms that none of these sources has differ by their smoothed shares.
    """
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])
    names = rows.filter(pa.compute.is_null(rows["term"]))
    sources, sides = names["source"].to_pylist(), names["side"].to_numpy()
    totals, n_terms = names["total"].to_pylist(), names["n_terms"].to_pylist()
    place = {source: at for at, source in enumerate(sources)}
    facts = rows.filter(pa.compute.is_valid(rows["term"]))
    terms, known = _coded(facts["term"].combine_chunks())
    counts = np.zeros((len(sources), len(known)), object)
    at = np.array([place[s] for s in facts["source"].to_pylist()], np.int64)
    counts[at, terms] = facts["n"].to_pylist()
    # Whole numbers of Python where 64 bits might not do.
    kind = np.int64 if counts.size == 0 or int(counts.max()) < 1 << 32 else object
    under = np.array([[t + SMOOTHING * v] for t, v in zip(totals, n_terms)], kind)
    shares = (1 + SHARE_SCALE * (counts.astype(kind) + SMOOTHING) // np.maximum(under, 1)).astype(np.int64)
    none = (1 + SHARE_SCALE * SMOOTHING // np.maximum(under[:, 0], 1)).astype(np.int64)
    unseen = max(names["n"].to_pylist()) - len(known)
    one, two = np.flatnonzero(sides & 1), np.flatnonzero(sides & 2)
    out = []
    for a in one.tolist():
        sums = (np.abs(shares[two] - shares[a]).sum(axis=1) + unseen * np.abs(none[two] - none[a])).tolist()
        out += [(a, b, v) for b, v in zip(two.tolist(), sums) if b != a]
        out += [(b, a, v) for b, v in zip(two.tolist(), sums) if b != a and not (sides[a] == 3)]
    lang = rows["lang"][0].as_py()
    return pa.Table.from_pylist([{"lang": lang, "source": sources[a], "item": sources[b], "value": v} for a, b, v in out], schema=schema)


def _pairs(counts: DataFrame, kept: DataFrame, groups: DataFrame, tile_sources: int, tile_terms: int) -> DataFrame:
    """Rows (lang, source, item, value): all pairs of different sources of a language.

    `counts(lang, source, term, n)` holds what occurs, `kept(lang, term)` all kept terms, and
    `groups(lang, source, total, n_terms)` all groups.
    """
    sizes = groups.groupBy("lang").agg(F.ceil(F.count("*") / tile_sources).alias("n_tiles"))
    known = groups.join(sizes, "lang").withColumn("tile", F.pmod(F.xxhash64("source"), F.col("n_tiles")))
    known = materialise(known.withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("n_terms") / tile_terms))), "divergence-groups")
    block = F.pmod(F.xxhash64("term"), F.col("n_blocks")).alias("block")
    blocks = kept.join(broadcast_if_bounded(known.select("lang", "n_blocks").distinct()), "lang").groupBy("lang", block).agg(F.count("*").alias("n"))
    marks = known.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))).join(
        broadcast_if_bounded(blocks), ["lang", "block"], "left"
    ).select("lang", "source", F.lit(None).cast("binary").alias("term"), F.coalesce("n", F.lit(0)).alias("n"), "total", "n_terms", "tile", "n_tiles", "block")
    facts = counts.join(broadcast_if_bounded(known), ["lang", "source"]).select(
        "lang", "source", "term", "n", "total", "n_terms", "tile", "n_tiles", block
    )
    dealt = marks.union(facts).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_tiles") - 1)))
    dealt = dealt.withColumn("one", F.least("tile", "other")).withColumn("two", F.greatest("tile", "other"))
    side = F.when(F.col("one") == F.col("two"), 3).when(F.col("tile") == F.col("one"), 1).otherwise(2)
    parts = dealt.withColumn("side", side).groupBy("lang", "block", "one", "two").applyInArrow(
        _tile_differences, "lang string, source string, item string, value long"
    )
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS, tile_sources: int = TILE_SOURCES,
                      tile_terms: int = TILE_TERMS, first_level: int = FIRST_LEVEL) -> DataFrame:
    """Rows (lang, source, part, item, value, rank).

    Part `pair`: each other source of the language, by the sum over kept terms of the difference of
    shares. Part `term`: the kept terms that a source uses more than its language, the first
    `top_terms` by how much more.
    """
    texts = docs.select(
        F.coalesce(F.col(f"`{lang_col}`"), F.lit("")).cast("string").alias("lang"),
        F.coalesce(F.col(f"`{source_col}`"), F.lit("")).cast("string").alias("source"), utf8(text_col).alias("body"),
    )
    documents = materialise(
        texts.repartitionByRange("lang", "source", F.xxhash64("body")).mapInArrow(
            _documents, "lang string, source string, terms binary, counts binary"
        ),
        "divergence-documents",
    )
    kept = frequent_terms(documents, min_documents, first_level)
    n_terms = kept.groupBy("lang").agg(F.count("*").alias("n_terms"))
    bits = documents.sparkSession.sparkContext.broadcast(_bitmap(kept))
    kept = kept.withColumnRenamed("prefix", "term")
    counts = documents.mapInArrow(_occurrences(bits), "lang string, source string, term binary, n long")
    counts = counts.join(broadcast_if_bounded(kept), ["lang", "term"], "left_semi")
    counts = materialise(counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n")), "divergence-counts")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = documents.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(n_terms, "lang", "left")
    groups = materialise(
        groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("n_terms", F.lit(0)).alias("n_terms")),
        "divergence-groups",
    )
    pairs = _pairs(counts, kept, groups, tile_sources, tile_terms).withColumn("part", F.lit("pair"))

    languages = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    in_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    both = counts.join(in_lang, ["lang", "term"]).join(broadcast_if_bounded(groups.join(languages, "lang")), ["lang", "source"])
    more = _share(F.col("n"), F.col("total"), F.col("n_terms")) - _share(F.col("lang_n"), F.col("lang_total"), F.col("n_terms"))
    terms = both.select("lang", "source", F.col("term").cast("string").alias("item"), more.alias("value"), F.lit("term").alias("part"))

    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(best).alias("rank")
    columns = ["lang", "source", "part", "item", "value"]
    return pairs.select(*columns, rank).union(terms.where("value > 0").select(*columns, rank).where(F.col("rank") <= top_terms))


DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), words AS (
  SELECT doc, lang, source, unnest(terms) AS term FROM docs
), kept AS (
  SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 30
), counts AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), v AS (
  SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang
), sums AS (
  SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY ALL
), groups AS (
  SELECT DISTINCT d.lang, d.source, coalesce(s.total, 0)::HUGEINT AS total, coalesce(v.v, 0)::HUGEINT AS v
  FROM docs d LEFT JOIN sums s USING (lang, source) LEFT JOIN v USING (lang)
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v) AS p
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
), whole AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(c.n) + 5)) // (any_value(t.total) + 5 * any_value(t.v)) AS q
  FROM counts c JOIN (SELECT lang, sum(total)::HUGEINT AS total, any_value(v) AS v FROM groups GROUP BY lang) t USING (lang)
  GROUP BY lang, term
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce((SELECT sum(abs(p.p - q.p)) FROM shares p JOIN shares q USING (lang, term)
                   WHERE p.lang = a.lang AND p.source = a.source AND q.source = b.source), 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 50
"""
