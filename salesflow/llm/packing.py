"""Hierarchical multi-length packing of tokenized documents.

Context tiers are powers of two up to the longest window.  A document is cut
into whole windows of the longest tier; what remains is routed to the smallest
tier that holds it.  Each tier is packed into sequences of its own length, from
long to short: the longest pieces open sequences, and the gap of a sequence is
filled by the largest pieces of the tier and then of shorter tiers that fit; what
is still open is closed by cutting one piece.  The last sequence of a block of
documents is cut into powers of two, so that none is padded.  Sequences of all
tiers are dealt to step groups of equal tokens.

A block is a bounded run of rows of one input partition.  Blocks need nothing
from each other: there is no shuffle, and a task that is run again gives a
complete packing of its rows.
"""

from __future__ import annotations

import os
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm._shared import given
from salesflow.llm.bpe import _OTHER as OTHER
from salesflow.llm.bpe import Codec, Vocabulary, byte_alphabet

WINDOW = 2048
#: Context sizes: this one, and its doubles up to the window.
SHORTEST = 512
#: A block ends with the document that brings it to so many tokens or rows.
BLOCK_TOKENS, BLOCK_ROWS = 4_000_000, 20_000
#: Tokens of a step group.
STEP_TOKENS = 64 * WINDOW
END = 1
#: Fixed value: the public byte-level pre-token pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens that a worker's memo holds, about 200 bytes each.
ROOM = 300_000


class Piece(NamedTuple):
    doc: int  # row in the block
    start: int
    length: int


def tiers(window: int = WINDOW, shortest: int = SHORTEST) -> list[int]:
    """Powers of two from ``shortest`` to ``window``."""
    if window & (window - 1) or shortest & (shortest - 1) or not 0 < shortest <= window:
        raise ValueError("tiers are powers of two")
    return [1 << b for b in range(shortest.bit_length() - 1, window.bit_length())]


def pack(lengths: list[int], window: int = WINDOW, shortest: int = SHORTEST) -> list[list[Piece]]:
    """Sequences of pieces that hold every token of the documents once.  Each
    tier is packed into sequences of its own length; only the very last tokens
    are cut into sequences of smaller powers of two."""
    sequences: list[list[Piece]] = []
    sizes = tiers(window, shortest)
    # one sorted list of open pieces for each tier: (length, document, start)
    open_: list[list[tuple[int, int, int]]] = [[] for _ in sizes]

    def tier_of(n: int) -> int:
        return bisect_left(sizes, n)

    for doc, n in enumerate(lengths):
        whole = n // window * window
        sequences += [[Piece(doc, at, window)] for at in range(0, whole, window)]
        if n > whole:
            open_[tier_of(n - whole)].append((n - whole, doc, whole))
    for t in open_:
        t.sort()

    def take(most: int, tier: int) -> tuple[int, int, int] | None:
        """The largest piece of ``most`` tokens or fewer, shorter tiers last."""
        for t in reversed(range(min(tier, tier_of(most)) + 1)):
            if open_[t] and open_[t][0][0] <= most:
                return open_[t].pop(bisect_right(open_[t], (most, len(lengths), 0)) - 1)
        return None

    for tier in reversed(range(len(sizes))):
        while open_[tier]:
            n, doc, start = open_[tier].pop()  # the longest opens a sequence
            sequence, gap = [Piece(doc, start, n)], sizes[tier] - n
            while gap and any(open_[:tier + 1]):
                got = take(gap, tier)
                if got is None:  # nothing fits: the smallest piece is cut, its rest stays open
                    n, doc, start = next(t for t in open_ if t).pop(0)
                    got = (gap, doc, start)
                    insort(open_[tier_of(n - gap)], (n - gap, doc, start + gap))
                sequence.append(Piece(got[1], got[2], got[0]))
                gap -= got[0]
            sequences += [sequence] if not gap else _powers(sequence)
    return sequences


def _powers(sequence: list[Piece]) -> list[list[Piece]]:
    """The last sequence, cut at powers of two."""
    out, used = [], sum(p.length for p in sequence)
    for b in reversed(range(used.bit_length())):
        if used >> b & 1:
            need, part = 1 << b, []
            while need:
                p = sequence.pop(0)
                if p.length > need:
                    sequence.insert(0, Piece(p.doc, p.start + need, p.length - need))
                    p = Piece(p.doc, p.start, need)
                part.append(p)
                need -= p.length
            out.append(part)
    return out


def step_groups(lengths: list[int], tokens: int = STEP_TOKENS) -> list[int]:
    """A step group for each sequence: long sequences first, each to the group
    with the fewest tokens so far, with as few groups as hold them."""
    groups = max(1, -(-sum(lengths) // tokens))
    full, out = np.zeros(groups, np.int64), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        out[i] = g = int(full.argmin())
        full[g] += lengths[i]
    return out


class LibraryCodec(Codec):
    """Encoder whose ids come from public libraries.  Whole texts go through
    ``tiktoken``, given the vocabulary as ranks, where that is the same: ids
    rise with the merges, and the text has no character whose class depends on
    the Unicode version.  The rest is cut by the tokenizer itself, and its model
    encodes the pre-tokens, written in the byte alphabet."""

    room = ROOM

    def __init__(self, text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core alone
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_str(text).model
        self.visible = {b: c for c, b in byte_alphabet().items()}
        v = Vocabulary(text)
        self._prepare(v)
        made = sorted((v.rank[i], i) for i in v.plain if v.rank[i] >= 0)
        self.whole = None
        if all(a < b for (_, a), (_, b) in zip(made, made[1:])):
            import tiktoken
            self.whole = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={v.bytes[i]: i for i in v.plain},
                                           special_tokens={})

    def _plain(self, text: str) -> bytes:
        if self.whole is None or not text.isascii() and OTHER.search(text):
            return super()._plain(text)
        return np.asarray(self.whole.encode_to_numpy(text, disallowed_special=()), "<u4").tobytes()

    def encode_words(self, words: list[str]) -> list[list[int]]:
        tokenize, visible = self.model.tokenize, self.visible
        return [[t.id for t in tokenize(w.encode().decode("latin-1").translate(visible))] for w in words]


_CODECS: dict[str, LibraryCodec] = {}


def _codec(text: str) -> LibraryCodec:
    if text not in _CODECS:
        _CODECS.clear()
        _CODECS[text] = LibraryCodec(text)
    return _CODECS[text]


def pack_documents(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, shortest: int = SHORTEST, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``id_col``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset``, ``tier`` (tokens of the whole
    sequence), ``step_group``, ``cut`` (the piece is not a whole document) and,
    ``with_ids``, its ``ids``.

    A document is its ids (whole text, null as empty) and then id 1, so an
    empty one is one token.  Sequence and group ids hold the partition, the
    block and the number in it.  Repeated rows are documents of their own; an
    empty table gives no rows.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        made = given(docs.sparkSession, f.read())

    names = ["_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group", "cut",
             *["ids"] * with_ids]

    def close(ids: list, encoded: list[bytes], base: int) -> pa.RecordBatch:
        total = [len(e) >> 2 for e in encoded]
        sequences = pack(total, window, shortest)
        size = [sum(p.length for p in s) for s in sequences]
        group = step_groups(size)
        rows = []
        for n, s in enumerate(sequences):
            offset = 0
            for doc, start, length in s:
                part = memoryview(encoded[doc])[4 * start:4 * (start + length)]
                rows.append((ids[doc], start, length, crc32(part), total[doc], base + n, offset, size[n], base + group[n],
                             length < total[doc], *([np.frombuffer(part, "<u4").astype(np.int32)] * with_ids)))
                offset += length
        kinds = [pa.string(), *[pa.int64()] * 8, pa.bool_(), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _codec(made.value)
        end = np.array([END], "<u4").tobytes()
        block, ids, encoded, tokens = 0, [], [], 0
        place = TaskContext.get().partitionId() << 40
        for b in batches:
            for at in range(0, b.num_rows, 256):  # few texts at a time
                part = b.slice(at, 256)
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    encoded.append(c.encode_bytes(text) + end)
                    ids.append(i)
                    tokens += len(encoded[-1]) >> 2
                    if tokens >= BLOCK_TOKENS or len(ids) >= BLOCK_ROWS:
                        yield close(ids, encoded, place + (block << 24))
                        block, ids, encoded, tokens = block + 1, [], [], 0
        if ids:
            yield close(ids, encoded, place + (block << 24))

    # ids travel as text, so that null ids and any type pass unchanged
    kind = docs.schema[id_col].dataType
    schema = ("_id string, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
              "offset bigint, tier bigint, step_group bigint, cut boolean" + ", ids array<int>" * with_ids)
    return (docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).alias("_text"))
            .mapInArrow(run, schema).withColumn("_id", F.col("_id").cast(kind)).withColumnRenamed("_id", id_col))
