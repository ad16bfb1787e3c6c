"""BPE and packing against the tokenizers library, and the packing laws."""

from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from salesflow.llm import bpe, packing
from salesflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library(vocabulary):
    return Tokenizer.from_file(vocabulary)


@pytest.fixture(scope="module")
def coder(vocabulary):
    return bpe.codec(bpe.Matcher(bpe.Vocabulary(open(vocabulary).read())))


def test_codec_equals_library(coder, library):
    @settings(max_examples=400, deadline=None)
    @given(st.text(max_size=60) | st.text("ab c\n'stl1. ", max_size=60) | st.text("aeinorst", max_size=80))
    def same(text):
        ids = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text).tolist() == ids
        assert coder.decode(np.array(ids, "<u4")) == library.decode(ids, skip_special_tokens=False)
    same()


def test_a_full_memo_changes_nothing(coder, library, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS", 5)
    coder.words.clear()
    coder.older.clear()
    for text in ("one two three four five six", "one two three seven", "one eight two nine three", "one ten", "two one") * 3:
        assert coder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_compatible_is_what_encoding_says(coder, library):
    rng = np.random.default_rng(1)
    v = coder.vocabulary
    short = [i for i in v.plain if v.bytes[i].isalpha() and v.bytes[i].isascii()]
    for a, b in rng.choice(short, (3000, 2)).tolist():
        word = (v.bytes[a] + v.bytes[b]).decode()
        assert v.compatible(a, b) == (library.encode(word, add_special_tokens=False).ids == [a, b])


def test_suffix_automaton_knows_all_substrings():
    words = [b"abcbc", b"bcbca", b"aaaa", b"abcbc"]
    go, link, most = bpe.suffix_automaton(words)
    parts = {w[i:j] for w in words for i in range(len(w)) for j in range(i, len(w) + 1)}

    def walk(s):
        at = 0
        for c in s:
            if c not in go[at]:
                return None
            at = go[at][c]
        return at
    assert all(walk(p) is not None for p in parts)
    assert all(walk(p + bytes([c])) is None for p in parts for c in b"abcd" if p + bytes([c]) not in parts)
    assert all(most[walk(p)] >= len(p) > most[link[walk(p)]] for p in parts if p)


def test_op2_equals_library(spark, library):
    got = {r["doc_id"]: r for r in QUERIES["op2_bpe"](spark, SF).collect()}
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    for r in texts:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        g = got[r["doc_id"]]
        assert (g["n_tokens"], g["ids_sha256"]) == (len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert g["decoded_sha256"] == sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_odd_rows(odd, none, vocabulary, library):
    rows = bpe.encode_documents(odd, vocabulary).collect()
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, tuple(library.encode(r["text"] or "", add_special_tokens=False).ids), r["text"] or "") for r in odd.collect())
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, tuple(r["ids"]), r["decoded"]) for r in rows) == want
    assert bpe.encode_documents(none, vocabulary).count() == 0


def check_packing(rows, want, window=2048):
    """want: ids of each document, the end id included."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(want)
    for d, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(want[d])
            assert r["ids_crc32"] == crc32(np.array(want[d][at:at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(want[d])
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window and at & (at - 1) == 0 and {r["tier"] for r in pieces} == {at}


def test_op1_packs_all(spark, library):
    rows = QUERIES["op1_packing"](spark, SF).collect()
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check_packing(rows, {r["doc_id"]: [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in texts})
    steps = defaultdict(dict)
    for r in rows:
        steps[r["step_group"]][r["sequence_id"]] = r["tier"]
    sums = [sum(x.values()) for x in steps.values()]
    assert max(sums) - min(sums) <= 2048


def test_packing_odd_rows(odd, none, vocabulary, library):
    one = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    check_packing(packing.pack_documents(one, vocabulary).collect(),
                  {r["doc_id"]: [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in one.collect()})
    whole = packing.pack_documents(odd, vocabulary, with_ids=True).collect()
    assert sum(r["length"] for r in whole) == sum(len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in odd.collect())
    assert all(len(r["ids"]) == r["length"] for r in whole)
    assert packing.pack_documents(none, vocabulary).count() == 0


def test_each_tier_is_packed_into_its_own_length(spark):
    """Sequences of every context size, short documents in short ones, and gaps
    of long sequences filled from shorter tiers."""
    lengths = [100] * 1500 + [700] * 90 + [1500] * 50 + [5000] * 3
    made = packing.pack(lengths)
    size = [sum(p.length for p in s) for s in made]
    assert {512, 1024, 2048} <= set(size) and sum(size) == sum(lengths)
    assert sum(n not in (512, 1024, 2048) for n in size) <= 10  # powers of two of the last tokens
    assert any(n == 2048 and {lengths[p.doc] for p in s} >= {1500, 100} for n, s in zip(size, made))
    group = packing.step_groups(size, 8192)
    sums = [sum(n for n, g in zip(size, group) if g == x) for x in set(group)]
    assert max(sums) - min(sums) <= 2048
    mixed = [{n for n, g in zip(size, group) if g == x} for x in set(group)]
    assert sum(2048 in m and len(m) > 1 for m in mixed) * 2 > len(mixed)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 700), max_size=80), st.sampled_from([(64, 8), (128, 128), (256, 16)]))
def test_pack_holds_every_token_once(lengths, sizes):
    window, shortest = sizes
    held = defaultdict(list)
    for s in packing.pack(lengths, window, shortest):
        n = sum(p.length for p in s)
        assert n <= window and n & (n - 1) == 0
        for p in s:
            held[p.doc].append((p.start, p.length))
    for d, n in enumerate(lengths):
        at = 0
        for start, size in sorted(held[d]):
            assert start == at
            at += size
        assert at == n
