"""Token counts against the public libraries, over whole texts."""

from __future__ import annotations

import json
import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from salesflow.llm import token_counts
from salesflow.llm.queries import op13_token_counts


def plain(path, texts):
    if path.endswith(".model"):
        import sentencepiece
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(m.encode(t or "")) for t in texts]
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    return [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def hard_texts():
    """Texts that are cut at awkward places: runs of spaces over a cut, marks
    and contractions, special strings, letters without any boundary."""
    rng = random.Random(5)
    parts = ["don't ", "  ", "\n\n \n", "<|endoftext|>", "we'll", "été ", "日本語の文章", "123 45", "!?...", " a", "'s't", "\t", "x" * 30, "🙂 ", "<|endof", "text|>"]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(100, 900))) for _ in range(25)]
    return out + ["x" * 4000, " " * 4000, "ab" * 2500 + " end", "<|endoftext|>" * 300, "日本語" * 900, ("word " * 40 + "y" * 700) * 5]


@pytest.mark.parametrize("chunk, overlap", [(64, 40), (200, 60), (1000, 100)])
def test_chunks_are_spliced_to_the_library_count(spark, vocabulary, chunk, overlap):
    texts = hard_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = token_counts.count_tokens(df, vocabulary, chunk=chunk, overlap=overlap)
    assert {r.doc_id: r.n_tokens for r in got.collect()} == dict(enumerate(plain(vocabulary, texts)))


def test_chunks_overlap_and_cover(spark):
    text = "".join(chr(97 + i % 26) for i in range(1234)) + "🙂" * 30
    for n in (1234 + 30, 301, 430, 400, 431):
        df = spark.createDataFrame([(0, text[:n])], "row bigint, text string")
        got = [(r.k, r.text) for r in token_counts._chunks(df, 100, 30).orderBy("k").collect()]
        assert [k for k, _ in got] == list(range(len(got)))
        assert all(t == text[:n][k * 100:k * 100 + 130] for k, t in got)
        assert (len(got) - 1) * 100 + len(got[-1][1]) == n


def test_odd_rows_and_empty_table(spark, odd, none, vocabulary):
    got = rows(token_counts.count_tokens(odd, vocabulary, chunk=500, overlap=100))
    held = odd.select("doc_id", "text").collect()
    want = [(r.doc_id, len((r.text or "").encode()), n, n > 512)
            for r, n in zip(held, plain(vocabulary, [r.text for r in held]))]
    assert got == sorted(want, key=str)
    out = token_counts.count_tokens(none, vocabulary)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and out.isEmpty()


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json"])
def test_tokenizers_without_a_proof_count_whole_texts(spark, name):
    path = public_tokenizers.path(name)
    texts = ["Some words, and more.", None, "", "word " * 5000, "日本語 text"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, path).collect()}
    assert got == dict(enumerate(plain(path, texts)))


def test_margin_needs_context_free_special_strings(vocabulary):
    with open(vocabulary) as f:
        spec = json.load(f)
    assert token_counts.proven_margin(spec) == len("<|endoftext|>") + 2
    one = spec["added_tokens"][0]
    assert token_counts.proven_margin(spec | {"added_tokens": [one | {"lstrip": True}]}) is None
    assert token_counts.proven_margin(spec | {"added_tokens": [one | {"content": "aba"}]}) is None
    assert token_counts.proven_margin(spec | {"normalizer": {"type": "NFC"}}) is None
    assert token_counts.proven_margin(spec | {"pre_tokenizer": {"type": "Whitespace"}}) is None


def test_query_equals_the_library(spark, docs, vocabulary):
    held = docs.select("doc_id", "text").collect()
    want = Counter((r.doc_id, len((r.text or "").encode()), n, n > 512)
                   for r, n in zip(held, plain(vocabulary, [r.text for r in held])))
    assert Counter(map(tuple, op13_token_counts(spark, "/root/testdata/sf0.001").collect())) == want


def test_huge_text_is_shared_by_many_tasks(spark, vocabulary):
    df = spark.range(1).select(F.col("id").alias("doc_id"), F.expr("repeat('many words of one text, ', 20000)").alias("text"))
    want = plain(vocabulary, ["many words of one text, " * 20000])
    assert [r.n_tokens for r in token_counts.count_tokens(df, vocabulary).collect()] == want
    chunks = token_counts._chunks(df.select(F.col("doc_id").alias("row"), "text"), token_counts.CHUNK, token_counts.OVERLAP)
    assert chunks.repartition(8, "row", "k").select(F.spark_partition_id().alias("p")).distinct().count() > 1
