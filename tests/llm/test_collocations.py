"""Collocations against plain counting of every phrase."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from salesflow.llm import collocations
from salesflow.llm.queries import op12_collocations

LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, least, top, longest=5):
    """Every phrase counted, every longer phrase looked at."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(w[i:i + m] for i in range(len(w) - m + 1))
    out = set()
    for lang, counts in f.items():
        c = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        held = set()
        for q, b in c.items():
            for m in range(2, len(q)):
                held |= {q[i:i + m] for i in range(len(q) - m + 1) if 100 * b >= 100 * c[q[i:i + m]]}
        kept = []
        for p, a in c.items():
            if p not in held:
                score, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                     for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return out


def corpus(seed, size=150):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["The", "é", "日本", "a-b", " x"]
    weight = [1 / (i + 1) for i in range(len(words))]
    fixed = [" ".join(rng.choices(words, weight, k=rng.randint(2, 7))) for _ in range(12)]
    rows = []
    for _ in range(size):
        text = "".join(rng.choice(fixed) + rng.choice([" ", "  ", ", ", ".\n", "\t", " "]) if rng.random() < 0.5
                       else rng.choices(words, weight)[0] + rng.choice([" ", " ", " ", "! ", "\r\n"]) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "en", "en", "fr", None]), text))
    return rows


@pytest.mark.parametrize("seed, least, top, first", [(1, 3, 10, 0.01), (2, 3, 5, 0.05), (3, 5, 10_000, 0.125), (4, 2, 40, 0.3), (5, 4, 1, 0.01)])
def test_equals_plain_counting(spark, seed, least, top, first):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = collocations.collocations(df, least=least, top=top, first=first)
    assert {tuple(r) for r in got.collect()} == plain(rows, least, top)


def test_few_buckets_let_through_but_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BUCKETS", 8)
    rows = corpus(6)
    df = spark.createDataFrame(rows, "lang string, text string")
    got = collocations.collocations(df, least=3, top=10, first=0.02)
    assert {tuple(r) for r in got.collect()} == plain(rows, 3, 10)


def test_colliding_hashes_take_another_seed(spark, monkeypatch):
    real = collocations.word_hash
    monkeypatch.setattr(collocations, "word_hash", lambda lang, w, seed: 1 + real(lang, w, seed) % 7 if seed == 0 else real(lang, w, seed))
    rows = corpus(7, 40)
    got = collocations.collocations(spark.createDataFrame(rows, "lang string, text string"), least=3, top=20)
    assert {tuple(r) for r in got.collect()} == plain(rows, 3, 20)


def test_settles_before_all_words_are_expanded(spark, monkeypatch):
    """Bound and branch: rare pairs that always stand together settle the
    language, so that frequent words are never expanded."""
    rows = [("en", f"rare{i % 40} mate{i % 40}. " + "the of " * 30) for i in range(400)]
    seen = []
    real = collocations._phrases

    def spy(coded, lengths, flags, pairs=None):
        seen.append(sorted(set(flags.value[1].tolist())))
        return real(coded, lengths, flags, pairs)

    monkeypatch.setattr(collocations, "_phrases", spy)
    df = spark.createDataFrame(rows, "lang string, text string")
    got = {tuple(r) for r in collocations.collocations(df, least=3, top=20, first=0.01).collect()}
    assert got == plain(rows, 3, 20)
    assert all(collocations.LATER in kinds for kinds in seen)  # "the" and "of" stay beyond the limit


def test_odd_rows_long_pieces_and_empty_table(spark, odd, none):
    rows = [(r.lang, r.text) for r in odd.collect()] + [("en", "p q " * 5000), (None, "p q " * 3), ("und", "p q")]
    df = spark.createDataFrame(rows, "lang string, text string")
    for least in (2, 4):
        got = collocations.collocations(df, least=least, top=50)
        assert {tuple(r) for r in got.collect()} == plain(rows, least, 50)
    assert {tuple(r) for r in collocations.collocations(odd, least=2).collect()} == plain([(r.lang, r.text) for r in odd.collect()], 2, 2000)
    empty = collocations.collocations(none)
    assert empty.isEmpty() and empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_query_and_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text").collect()]
    want = plain(rows, 100, 2000)
    assert {tuple(r) for r in op12_collocations(spark, sf).collect()} == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert set(con.execute(collocations.oracle()).fetchall()) == want
    assert set(con.execute(collocations.oracle(least=20, top=50)).fetchall()) == plain(rows, 20, 50)
