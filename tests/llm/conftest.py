"""Fixtures of the training-data operators (the session comes from above)."""

from __future__ import annotations

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

CLASHING = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, digest string, component_id string, dropped_lines string, lang_pred string"

TEXTS = [
    None, "", " ", "\n\n", "a", "A", "the quick brown fox jumps over the lazy dog",
    "The Quick Brown Fox Jumps Over The Lazy Dog", "the quick brown fox jumps over the lazy dog",
    "word " * 3000, "x" * 20000, "日本語 の 文章 です", "tab\tand\x0bvertical \x1c sep", "line one of the text here\nline two of the text here",
    "<|endoftext|> inside <|endoftext|>", "don't  stop\n \n  now ", "é" * 50, "1 2 3 4 5 6 7 8"]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and
    extra columns whose names clash with results."""
    rows = [(i, t, "en", "s", 1, "x", "x", "x", "x", "x") for i, t in enumerate(TEXTS)]
    rows += [rows[6], rows[6], (None, "no id here at all today", None, None, None, *[None] * 5), (None, None, *[None] * 8)]
    return spark.createDataFrame(rows, CLASHING)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], CLASHING)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def vocabulary():
    return public_tokenizers.path("byte_bpe_50k.json")
