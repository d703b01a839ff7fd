"""What Python workers remember is bounded, and of one operator at a time."""

from __future__ import annotations

import gc

from tidefold.llm import common, tokens, toxicity


def test_a_worker_remembers_words_of_one_operator(byte_bpe):
    encoder = tokens.encoder(byte_bpe)
    encoder.encode("some words that are remembered")
    before = sum(isinstance(o, tokens.PieceEncoder) for o in gc.get_objects())
    del encoder
    toxicity.features(b"other words")
    common.sole_cache(toxicity._hashes)
    assert toxicity._hashes and not tokens._encoders
    assert sum(isinstance(o, tokens.PieceEncoder) for o in gc.get_objects()) < before
    assert tokens.encoder(byte_bpe).encode("more words") and not toxicity._hashes


def test_word_hashes_are_few_and_do_not_change_features():
    words = [b"w%d" % n for n in range(3 * toxicity._CACHE_WORDS)]
    toxicity.features(b" ".join(words))
    assert len(toxicity._hashes) <= toxicity._CACHE_WORDS <= 100_000
    text = b" ".join(words[:100])
    assert (toxicity.features(text) == toxicity.features(text)).all()
