"""Line dedup by a log-template tree.

A line is parsed to a fixed depth: its token count, then its leading tokens,
name a leaf.  Fields that vary are generalised: a token with a digit is a
wildcard everywhere, and the tail of a line, cut into parts, may differ in one
part of a few tokens, which then is a field.  So a line has one key for its
template as it stands and one for each short part left open; a key that several
documents hold is a recurring template.  What stands in an open part counts as a
field only if three documents hold the template and three different fillings of
it are seen: else it is text of its own, which two documents happen to share the
rest of.  Lines of a recurring template stay in the document with the smallest id
and are dropped from the others.

A line of few tokens generalises to nothing: its one key is the line itself.
In scripts written without spaces each character is a token.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm._shared import shared_table

#: Leading tokens that name a leaf, parts of the tail, tokens that a line needs
#: to be generalised, and documents that make a template recurring.
DEPTH, PARTS, MIN_TOKENS, MIN_DOCS = 3, 3, 5, 2
#: Documents that make a line of fewer than MIN_TOKENS tokens recurring, unless
#: the caller says otherwise (operator 8 and the pipeline do: MIN_DOCS).
SHORT_DOCS = 3
#: Tokens of an open part at most, and the documents and different fillings that
#: make it a field.
FIELD_TOKENS, FIELD_DOCS, FIELD_KINDS = 3, 3, 3
#: Bytes of a key; that of a short line has one less, that with an open part one
#: more, which tells them apart.
_KEY = 12
WILDCARD = "<*>"
_DIGIT = regex.compile(r"\d")
#: Scripts written without spaces: South-East Asian and Tibetan, kana, bopomofo,
#: Han, Yi and their extensions.
_UNSPACED = ("\u0e00-\u109f\u1780-\u17ff\u1950-\u1aaf\u1b00-\u1b7f\u2e80-\u2fdf\u3005-\u3007\u3021-\u3029\u3031-\u312f"
             "\u31a0-\u31ff\u3400-\u4dbf\u4e00-\ua4cf\ua980-\ua9df\uaa00-\uaadf\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f"
             "\U00020000-\U0003ffff")
_HAS_UNSPACED, _TOKEN = re.compile(f"[{_UNSPACED}]"), re.compile(rf"[{_UNSPACED}]|[^\s{_UNSPACED}]+")


def _digest(key: str, size: int) -> bytes:
    return xxhash.xxh3_128_digest(key.encode("utf-8", "replace"))[:size]


def template_keys(line: str, depth: int = DEPTH, parts: int = PARTS, min_tokens: int = MIN_TOKENS) -> list[tuple[bytes, int]]:
    """The keys of a line, none if it is blank, each with the filling of its open
    part (one of 64 marks; of other keys -1).

    A line of fewer than ``min_tokens`` tokens has one key: its tokens as they
    are.  If over half the tokens would be wildcards, the tokens themselves are
    the template and nothing is left open, so that rows of numbers do not fall
    together.  A part is left open only if it has up to ``FIELD_TOKENS`` tokens
    and the tail has as many as parts.  Characters say less than words: where
    they are the tokens, a part may have, and the tail must have, twice as many.
    """
    tokens, room, most = line.split(), parts, FIELD_TOKENS
    if not line.isascii() and _HAS_UNSPACED.search(line):
        tokens, room, most = _TOKEN.findall(line), 2 * parts, 2 * FIELD_TOKENS
    n = len(tokens)
    if n < min_tokens:
        return [(_digest(f"{n}\x1dexact\x1d" + " ".join(tokens), _KEY - 1), -1)] if n else []
    if _DIGIT.search(line):
        masked = [WILDCARD if _DIGIT.search(t) else t for t in tokens]
        if 2 * masked.count(WILDCARD) > n:
            return [(_digest(f"{n}\x1dexact\x1d" + " ".join(tokens), _KEY), -1)]
        tokens = masked
    leaf, tail = f"{n}\x1d" + " ".join(tokens[:depth]), tokens[depth:]
    t = len(tail)
    keys = [(_digest(leaf + "\x1d" + " ".join(tail), _KEY), -1)]
    if parts > 1 and room <= t < parts * (most + 1):
        cut = [" ".join(tail[t * p // parts:t * (p + 1) // parts]) for p in range(parts)]
        keys += [(_digest(leaf + "\x1d" + "\x1d".join([*cut[:p], "\x1dopen", *cut[p + 1:]]), _KEY + 1),
                  xxhash.xxh3_64_intdigest(cut[p].encode("utf-8", "replace")) % 64)
                 for p in range(parts) if t * (p + 1) // parts - t * p // parts <= most]
    return keys


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
                    parts: int = PARTS, min_tokens: int = MIN_TOKENS, min_docs: int = MIN_DOCS,
                    short_docs: int = SHORT_DOCS) -> DataFrame:
    """``_id``, ``_text_hash``, ``dropped`` (line numbers from 0): the lines to
    drop, one row per document that loses any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):  # the keys of a few documents at a time
                part = b.slice(at, 256)
                keys, row, lines, fills = [], [], [], []
                for r, text in enumerate(part.column(2).to_pylist()):
                    held: dict[bytes, list[int]] = {}
                    kinds: dict[bytes, int] = {}
                    for n, line in enumerate(text.split("\n")):
                        for k, fill in template_keys(line, depth, parts, min_tokens):
                            held.setdefault(k, []).append(n)
                            kinds[k] = kinds.get(k, 0) | (1 << fill if fill >= 0 else 0)
                    keys += held.keys()
                    lines += held.values()
                    row += [r] * len(held)
                    fills += map(kinds.__getitem__, held)
                row = pa.array(row, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), part.column(0).take(row), part.column(1).take(row),
                     pa.array(lines, pa.list_(pa.int32())), pa.array(np.array(fills, np.uint64).view(np.int64))],
                    ["key", "_id", "_text_hash", "lines", "fills"])

    kind = docs.schema[id_col].dataType.simpleString()
    # parsed once: both uses read the written keys
    held = shared_table(
        docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_text_hash"),
                    F.col(text_col).cast("string").alias("_text"))
        .where("_id is not null and _text is not null")
        .select("_id", "_text_hash", "_text")
        .mapInArrow(run, f"key binary, _id {kind}, _text_hash bigint, lines array<int>, fills bigint"), "template-keys")
    size = F.octet_length("key")
    least = F.when(size < _KEY, short_docs).when(size > _KEY, max(FIELD_DOCS, min_docs)).otherwise(min_docs)
    # min, max, count and marks are combined on the map side: a line of every document is a few rows
    found = shared_table(
        held.groupBy("key").agg(F.min("_id").alias("first"), F.max("_id").alias("last"), F.count(F.lit(1)).alias("n"),
                                F.bit_or("fills").alias("fills"))
        .where((F.col("first") != F.col("last")) & (F.col("n") >= least))
        .where((size <= _KEY) | (F.bit_count("fills") >= FIELD_KINDS)).select("key", "first"), "templates")
    return (held.join(found, "key").where(F.col("_id") != F.col("first"))
            .groupBy("_id", "_text_hash").agg(F.array_distinct(F.flatten(F.collect_set("lines"))).alias("dropped")))


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """All columns of ``docs`` with the text less its recurring lines, and
    ``dropped_lines`` (array of line numbers from 0, sorted, maybe empty).

    Null texts and rows with a null id stay as they are and make no template
    recurring.  A template recurs if ``min_docs`` rows of two or more ids hold
    it, a line of fewer than ``min_tokens`` tokens if ``short_docs`` do, one with
    an open part if ``FIELD_DOCS`` do and ``FIELD_KINDS`` fillings are seen (told
    apart by 64 marks: two of one mark count once, which keeps more).  Repeats
    within one document stay; every document stays, with an empty text if all
    its lines go.  An input column ``dropped_lines`` is replaced, all others
    are kept, whatever their names.
    """
    lines = shared_table(recurring_lines(docs, id_col, text_col, **settings), "dropped-lines")

    names = [c for c in docs.columns if c != "dropped_lines"]
    at = names.index(text_col)
    mine = "_row"
    while mine in names:  # one struct beside the lines: no name can clash
        mine += "_"

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, d in zip(b.column(at), b.column(len(names))):
                d = d.as_py()
                if t.is_valid and d:
                    gone = set(d)
                    out.append("\n".join(x for n, x in enumerate(t.as_py().split("\n")) if n not in gone))
                else:
                    out.append(t.as_py())
            yield b.set_column(at, b.schema.field(at).name, pa.array(out, b.schema.field(at).type))

    given = docs.select(F.struct(*(F.col(f"`{n}`") for n in names)).alias(mine), F.col(f"`{id_col}`").alias(f"{mine}id"),
                        F.xxhash64(F.col(f"`{text_col}`")).alias(f"{mine}hash"))
    found = lines.select(F.col("_id").alias(f"{mine}of"), F.col("_text_hash").alias(f"{mine}text"), F.col("dropped").alias(f"{mine}gone"))
    joined = (given.join(found, (F.col(f"{mine}id") == F.col(f"{mine}of")) & (F.col(f"{mine}hash") == F.col(f"{mine}text")), "left")
              .select(f"{mine}.*", F.array_sort(F.coalesce(f"{mine}gone", F.array().cast("array<int>"))).alias("dropped_lines")))
    return joined.mapInArrow(rest, joined.schema)
