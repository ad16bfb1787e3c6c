"""BPE encoding by per-prefix dynamic programming, and decoding.

For every prefix of a pre-token exactly one vocabulary token can end its
encoding.  The tokens that end at a position come from a suffix automaton of
the vocabulary; the one that is compatible with the last token of the prefix
before it is stored; back-pointers from the end give the ids.  Two tokens are
compatible if encoding their concatenation gives the two: undoing their merges
along the border, latest first, no merge across the border comes earlier.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPACE = r"\t-\r \x85\xa0 -     "
#: The public pre-token pattern ('s|'t|'re|'ve|'m|'ll|'d, then optional space
#: and letters, numbers or other marks, then white space), for the characters
#: outside _OTHER.
_CUT = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\w{_SPACE}]|[_\x1c-\x1f])+"
                  rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: A text with one of these characters is cut by the tokenizer itself: numbers
#: that are no digits, and scripts whose classes depend on the Unicode version.
_OTHER = regex.compile("[²³¹¼-¾՘-῿⁰-\U0010ffff]")
#: Entries of the memo of a Python worker: pre-tokens, and as many pairs of
#: tokens.  About 200 bytes an entry.  The memo has two halves: a full one
#: becomes the older half, from which words that are met again come back.
WORDS = 1_400_000


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary:
    visible Latin-1 characters stand for themselves, the rest are counted up
    from 256."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Vocabulary:
    """Merges and tokens of a byte-level BPE file (``tokenizers`` JSON)."""

    def __init__(self, text: str):
        spec = json.loads(text)
        alphabet, ids = byte_alphabet(), spec["model"]["vocab"]
        self.text = text
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or ()}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in ids.items():
            self.bytes[i] = bytes(alphabet[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.rank, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.merge: dict[tuple[int, int], int] = {}
        for n, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            i = ids[a + b]
            if self.rank[i] >= 0:
                raise ValueError("a token that two merges make has no single last step")
            self.rank[i], self.left[i], self.right[i] = n, ids[a], ids[b]
            self.merge[ids[a], ids[b]] = n
        self.plain = [i for i in ids.values()]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the bytes of ``a`` then ``b`` are encoded as ``a``, ``b``.

        Walk back in time from the finished pair.  What stands at the border
        stood there until ``limit``, the time of the merge undone last; a merge
        of the border's pair that comes before would have been taken.  Equal
        merges run from the left, so an undone merge on the right side loses
        against one of the same rank across the border.
        """
        rank, limit = self.rank, None
        while True:
            across = self.merge.get((a, b))
            if across is not None and (limit is None or 2 * across < limit):
                return False
            if rank[a] < 0 and rank[b] < 0:
                return True
            if rank[b] >= rank[a]:
                limit, b = 2 * rank[b] + 1, self.left[b]
            else:
                limit, a = 2 * rank[a], self.right[a]


def suffix_automaton(words: Iterable[bytes]) -> tuple[list[dict[int, int]], list[int], list[int]]:
    """Transitions, suffix links and greatest lengths of the automaton of all
    substrings of ``words``; state 0 is the empty string."""
    go: list[dict[int, int]] = [{}]
    link, most = [-1], [0]

    def split(p: int, q: int, c: int) -> int:
        """The state of the strings of ``q`` that ``p`` reaches by ``c``."""
        if most[q] == most[p] + 1:
            return q
        new = len(go)
        go.append(go[q].copy())
        link.append(link[q])
        most.append(most[p] + 1)
        link[q] = new
        while p >= 0 and go[p].get(c) == q:
            go[p][c] = new
            p = link[p]
        return new

    for word in words:
        at = 0
        for c in word:
            if c in go[at]:
                at = split(at, go[at][c], c)
                continue
            new = len(go)
            go.append({})
            link.append(0)
            most.append(most[at] + 1)
            p = at
            while p >= 0 and c not in go[p]:
                go[p][c] = new
                p = link[p]
            if p >= 0:
                link[new] = split(p, go[p][c], c)
            at = new
    return go, link, most


class Matcher:
    """The automaton of a vocabulary as arrays, to be broadcast: bounded by
    the vocabulary (about 0.7 million transitions for 50,000 tokens)."""

    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        go, link, most = suffix_automaton(v.bytes[i] for i in v.plain)
        token = np.full(len(go), -1, np.int32)
        for i in v.plain:
            at = 0
            for c in v.bytes[i]:
                at = go[at][c]
            token[at] = i
        up = np.zeros(len(go), np.int32)  # the nearest proper suffix that is a token
        for s in np.argsort(most, kind="stable")[1:].tolist():
            up[s] = link[s] if token[link[s]] >= 0 else up[link[s]]
        self.key = np.fromiter(((s << 8) | c for s, x in enumerate(go) for c in x), np.int64)
        self.to = np.fromiter((t for x in go for t in x.values()), np.int32)
        self.link, self.most, self.token, self.up = np.array(link, np.int32), np.array(most, np.int32), token, up
        self.text = v.text


def _little(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Codec:
    """Encoder and decoder of one Python worker, with bounded memos."""

    room = WORDS

    def __init__(self, matcher: Matcher):
        self._prepare(Vocabulary(matcher.text))
        v = self.vocabulary
        self.go = dict(zip(matcher.key.tolist(), matcher.to.tolist()))
        self.link, self.most = matcher.link.tolist(), matcher.most.tolist()
        self.token, self.up = matcher.token.tolist(), matcher.up.tolist()
        self.size = [len(b) for b in v.bytes]
        self.pairs: dict[int, bool] = {}

    def _prepare(self, v: Vocabulary) -> None:
        self.vocabulary = v
        self.words: dict[str, bytes] = {}  # the memo, and what it held before it was last full
        self.older: dict[str, bytes] = {}
        longest_first = sorted(v.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if v.special else None
        self.cutter = None

    def fits(self, a: int, b: int) -> bool:
        key = a << 20 | b
        if (known := self.pairs.get(key)) is None:
            if len(self.pairs) >= WORDS:
                self.pairs.clear()
            known = self.pairs[key] = self.vocabulary.compatible(a, b)
        return known

    def encode_word(self, word: bytes) -> list[int]:
        """The ids of one pre-token."""
        go, link, most, token, up, size = self.go, self.link, self.most, self.token, self.up, self.size
        last = [0] * (len(word) + 1)
        at = length = 0
        for end, c in enumerate(word, 1):
            while (to := go.get(at << 8 | c)) is None:
                at = link[at]
                length = most[at]
            at, length = to, length + 1
            state = at if length == most[at] and token[at] >= 0 else up[at]
            while state:
                t = token[state]
                start = end - most[state]
                if not start or self.fits(last[start], t):
                    last[end] = t
                    break
                state = up[state]
            else:
                raise ValueError("the vocabulary does not hold every byte")
        ids, end = [], len(word)
        while end:
            ids.append(last[end])
            end -= size[last[end]]
        return ids[::-1]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        return [self.encode_word(w.encode()) for w in words]

    def cut(self, text: str) -> list[str]:
        """The pre-tokens of a text."""
        if not text.isascii() and _OTHER.search(text):
            if self.cutter is None:
                from tokenizers import Tokenizer
                self.cutter = Tokenizer.from_str(self.vocabulary.text).pre_tokenizer
            return [text[a:b] for _, (a, b) in self.cutter.pre_tokenize_str(text)]
        return _CUT.findall(text)

    def _plain(self, text: str) -> bytes:
        words = self.cut(text)
        if len(self.words) >= self.room // 2:
            self.words, self.older = {}, self.words
        known = self.words
        got = list(map(known.get, words))
        if None in got:
            missing = {w for w, ids in zip(words, got) if ids is None}
            older = self.older
            known.update((w, older[w]) for w in missing if w in older)
            new = [w for w in missing if w not in known]
            known.update(zip(new, map(_little, self.encode_words(new))))
            got = list(map(known.__getitem__, words))
        return b"".join(got)

    def encode_bytes(self, text: str | None) -> bytes:
        """The ids of a whole text, four bytes each; null counts as empty."""
        if not text:
            return b""
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts = [_little([self.vocabulary.special[p]]) if p in self.vocabulary.special
                 else self._plain(p) if p else b"" for p in self.special.split(text)]
        return b"".join(parts)

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a whole text; null counts as empty."""
        return np.frombuffer(self.encode_bytes(text), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``, special tokens included; bytes that are not
        UTF-8 become replacement characters."""
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec(matcher: Matcher) -> Codec:
    """The worker's codec of this vocabulary, made once."""
    key = sha256(matcher.text.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(matcher)
    return _CODECS[key]


def encode_documents(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, ``ids`` (array of int) and ``decoded``
    (the text that the ids give back).  Null text counts as empty: no ids, empty
    text.  Whole texts are encoded; repeated rows give repeated rows."""
    with open(vocabulary_path, encoding="utf-8") as f:
        made = docs.sparkSession.sparkContext.broadcast(Matcher(Vocabulary(f.read())))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(made.value)
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.iloc[at:at + 512]
                ids = [c.encode(t) for t in part["_text"]]
                yield pd.DataFrame({"_id": part["_id"], "ids": [x.astype(np.int32) for x in ids],
                                    "decoded": [c.decode(x) for x in ids]})

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
            .mapInPandas(run, f"_id {kind}, ids array<int>, decoded string").withColumnRenamed("_id", id_col))


def document_digests(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of ``encode_documents`` made in the same pass, so that ids and
    texts do not leave the task: ``id_col``, ``n_tokens``, ``ids_sha256`` (of
    the ids as little-endian unsigned 32-bit integers), ``decoded_sha256``."""
    with open(vocabulary_path, encoding="utf-8") as f:
        made = docs.sparkSession.sparkContext.broadcast(Matcher(Vocabulary(f.read())))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(made.value)
        for b in batches:
            rows = []
            for t in b["_text"]:
                ids = c.encode(t)
                rows.append((len(ids), sha256(ids.tobytes()).hexdigest(),
                             sha256(c.decode(ids).encode("utf-8", "replace")).hexdigest()))
            n, a, d = zip(*rows) if rows else ((), (), ())
            yield pd.DataFrame({"_id": b["_id"], "n_tokens": n, "ids_sha256": a, "decoded_sha256": d})

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
            .mapInPandas(run, f"_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
            .withColumnRenamed("_id", id_col))
