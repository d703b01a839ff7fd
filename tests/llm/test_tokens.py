"""Token ids, packing, token files and their scan: round trips against the tokenizers library."""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import ROWS
from tidefold.llm.packing import best_fit, improve, pack, pack_lengths
from tidefold.llm.token_output import read_document, token_output, train_dictionary
from tidefold.llm.token_scan import scan_separators, token_counts
from tidefold.llm.tokens import PieceEncoder, encoder

ODD = [
    "", " ", "  ", "a ", " a", "a  b", "a\n b", "a \nb", "a\t b  c", "It's  don't,  x!? .. 12", "ΑΣ ΣΑΣ, İx é",
    "<|endoftext|> q <|startoftext|>", "  x \x1c y \x85 z", "ét é ﬁ Ǆ", "#*$ %, , a,",
]


def ids_of(path, text):
    return encoder(path).tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("which", ["byte_bpe", "word_bpe"])
def test_pieces_give_the_ids_of_the_whole_text(request, texts, which):
    path = request.getfixturevalue(which)
    for text in ODD + [t for _, t in texts]:
        got = array("I")
        got.frombytes(encoder(path).encode(text))
        assert got.tolist() == ids_of(path, text), repr(text[:80])


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab é,.'\n\t  1Σ ́İ*"), max_size=30))
def test_pieces_of_any_text(text):
    import public_tokenizers

    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        got = array("I")
        got.frombytes(encoder(path).encode(text))
        assert got.tolist() == ids_of(path, text)


def test_line_borders_are_not_pieces_of_their_own(byte_bpe):
    """The end of a line and the start of the next are looked up apart, so the pieces grow with the words and not with their pairs."""
    words = [f"{a}{b}" for a in ("tho", "ren", "sti", "ble") for b in ("ing", "est", "ia", "u", "or")]
    text = " ".join(f"{one}.\n{two.title()} é" for one in words for two in words)
    encoder_ = PieceEncoder(byte_bpe)
    got = array("I")
    got.frombytes(encoder_.encode(text))
    assert got.tolist() == ids_of(byte_bpe, text)
    assert len(encoder_.pieces) < 4 * len(words)


def test_local_search_empties_bins():
    # Best fit gives three bins here, two suffice: 5+3+2 and 4+4+2.
    lengths = [5, 4, 4, 3, 2, 2]
    bins = improve(lengths, [[0, 1], [2, 3, 4], [5]], 10)
    assert len(bins) == 2 and sorted(i for b in bins for i in b) == list(range(6))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_packing_is_valid_and_no_worse_than_best_fit(lengths):
    bins = pack_lengths(lengths, 64)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 64 for b in bins) and len(bins) <= len(best_fit(lengths, 64))


def check_packing(rows, texts, path, capacity):
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, text in texts:
        ids = np.array([*ids_of(path, text or ""), 0], "<u4")
        parts = sorted(docs[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts))) and sum(r.length for r in parts) == len(ids)
        assert all(r.length == capacity for r in parts[1:]) and (len(parts) == 1 or len(ids) > capacity)
        at = 0
        for r in parts:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
    return len(sequences)


def test_pack(documents, texts, odd_docs, no_docs, byte_bpe):
    rows = pack(documents, byte_bpe).collect()
    used = check_packing(rows, texts, byte_bpe, 2048)
    assert used <= -(-sum(r.length for r in rows) // 2048) + 3
    rows = pack(odd_docs, byte_bpe, capacity=64, group_pieces=4).collect()
    check_packing(rows, [(r[0], r[1]) for r in ROWS if r[0] != 7], byte_bpe, 64)
    assert sum(1 for r in rows if r.doc_id == 7) == 2 and pack(no_docs, byte_bpe).collect() == []


def test_separator_scan(spark, documents, texts, odd_docs, no_docs, word_bpe):
    want = {i: len(ids_of(word_bpe, t)) for i, t in texts}
    for size in ({}, {"file_bytes": 3000, "block_ids": 500}):
        rows = token_counts(documents.repartition(3), word_bpe, 49407, **size).collect()
        assert {r.doc_id: r.n_tokens for r in rows} == want and len(rows) == len(want)
    rows = token_counts(odd_docs, word_bpe, 49407).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in ROWS)
    assert token_counts(no_docs, word_bpe, 49407).collect() == []


def test_separator_scan_of_foreign_files(spark, tmp_path):
    """Documents across files and blocks, empty ones, and an open end."""
    streams = {"a": [5, 5, 0, 0, 7, 8, 9, 0, 4], "b": [0], "c": [1, 2, 3]}
    for name, ids in streams.items():
        data = np.array(ids, "<u2").tobytes()
        for n, at in enumerate(range(0, len(data), 6)):
            (tmp_path / f"{name}-{n:06d}.bin").write_bytes(data[at:at + 6])
    (tmp_path / "d-000000.bin").write_bytes(b"")
    for block in (1, 2, 100):
        rows = scan_separators(spark, str(tmp_path), 0, block_ids=block).collect()
        assert sorted((r.stream, r.ordinal, r.start, r.n_tokens, r.ended) for r in rows) == [
            ("a", 0, 0, 2, True), ("a", 1, 3, 0, True), ("a", 2, 4, 3, True), ("a", 3, 8, 1, False),
            ("b", 0, 0, 0, True), ("c", 0, 0, 3, False),
        ]


def test_token_output(spark, documents, texts, odd_docs, no_docs, word_bpe, tmp_path):
    def expected(rows):
        at, out = 0, []
        for doc_id, text in rows:
            ids = np.array([*ids_of(word_bpe, text), 2], "<u4")
            out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
            at += len(ids)
        return out

    folder = str(tmp_path / "out")
    got = token_output(documents, word_bpe, 2, folder=folder, shard_bytes=20_000).collect()
    assert sorted(tuple(r) for r in got) == expected(sorted(texts))
    names = sorted(p.name for p in (tmp_path / "out").glob("*.tok"))
    dictionary = (tmp_path / "out" / "dictionary.zdict").read_bytes()
    assert len(names) > 2 and dictionary == train_dictionary(documents, word_bpe)
    doc_id, text = min(texts)
    assert read_document(folder, names[0], doc_id, dictionary).tolist() == [*ids_of(word_bpe, text), 2]
    with pytest.raises(ValueError):
        from tidefold.llm.token_output import shard_index

        shard_index((tmp_path / "out" / names[0]).read_bytes(), b"another")

    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got = sorted((tuple(r) for r in token_output(odd_docs, word_bpe, 2).collect()), key=lambda r: r[1])
    assert got == expected([(r[0], r[1] or "") for r in order])
    assert token_output(no_docs, word_bpe, 2).collect() == []
