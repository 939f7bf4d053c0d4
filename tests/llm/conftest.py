from __future__ import annotations

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="session")
def tokenizer_path():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def tokenizer(tokenizer_path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path)


#: Texts that every operator must take: null, empty, blank, non-ASCII, controls, repeated, long.
ODD_TEXTS = [None, "", " \n\t ", "a", "été 中文 🙂", "\x00\x1c\x85  x", "same text here", "same text here", "word " * 30_000, "x" * 50_000, "<|endoftext|> a <|endoftext|>"]


@pytest.fixture
def odd_documents(spark):
    """Odd texts, a null and a repeated doc_id, and columns whose names operators use themselves."""
    rows = [(i, t, "en", i, "k", "f", "r") for i, t in enumerate(ODD_TEXTS)] + [(None, "no id at all", None, 1, "k", "f", "r"), (3, "a", "en", 3, "k", "f", "r")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n long, key string, found string, row string")
