from __future__ import annotations

import public_tokenizers
import pytest

# Null and empty texts, ties in A-Z case only, repeated rows, a null identifier, a long text.
ROWS = [
    (1, None, "src0"), (2, "", "src1"), (3, "Alpha beta gamma", None), (4, "alpha BETA gamma", "src0"),
    (5, "ÄPFEL und Öl", "src0"), (6, "äpfel und Öl", "src1"), (7, "one", "src1"), (7, "one", "src1"),
    (None, "no identifier here", "src0"), (8, "word " * 3000 + "end", "src0"),
    (9, "plain words in a row " * 30, "src2"), (10, "plain words in a row " * 30 + "!", "src2"),
]
SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Columns beyond the three clash with names the operators use inside."""
    extra = "keep_id string, fp string, body string, copy string, piece string, start string, label string, node string"
    rows = [(*r, *(["x"] * 8)) for r in ROWS]
    return spark.createDataFrame(rows, f"{SCHEMA}, {extra}")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return [(r.doc_id, r.text or "") for r in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def byte_bpe():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def word_bpe():
    return public_tokenizers.path("word_bpe_49k.json")
