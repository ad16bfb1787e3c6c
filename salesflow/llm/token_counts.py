"""Token counts by overlap resynchronisation.

A text of ordinary length is encoded as it is.  A huge one is cut into chunks
that overlap, so that many tasks share it.  Each chunk is encoded with the offsets of its
pre-tokens.
Two neighbours are spliced at a boundary that both have and that is proven
stable: the start of a pre-token in both.  The byte-level pattern looks at no
character before a match and at one character after it, so what follows such a
start is cut alike in both chunks and in the whole text, and merges never leave
a pre-token.  Where neighbours share no such boundary, the overlaps (and with
them the chunks) of that text are widened and it is encoded again.

A splice takes away the left chunk's tokens after it and the right chunk's
tokens before it, so a text's count is a plain sum over its chunks and splices:
no task ever holds all the chunks of a text.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm._shared import shared_table
from salesflow.llm.bpe import Codec, byte_alphabet

#: Characters of a chunk, of the overlap after it, and how many times wider
#: both become when neighbours don't align.
CHUNK, OVERLAP, WIDER = 16_384, 512, 8
#: Tokens beyond which a document is over the limit.
LIMIT = 512
#: Characters encoded in one call of the library.
AT_ONCE = 1 << 19
#: Pre-tokens in each half of a worker's memo, about 120 bytes each.  A full
#: half becomes the older one, from which words that are met again come back.
WORDS = 250_000


def proven_margin(spec: dict) -> int | None:
    """How far before the end of a chunk a pre-token start is as in the whole
    text: the pattern's look ahead and the longest special string.  None if the
    tokenizer is not byte-level with the public pattern, or if its special
    strings depend on what stands around them: then only whole texts count."""
    pre = spec.get("pre_tokenizer") or {}
    added = spec.get("added_tokens") or ()
    names = [t["content"] for t in added]
    if (pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True)
            or spec.get("normalizer") or any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))):
        return None
    overlapping = any(a.endswith(b[:n]) for a in names for b in names for n in range(1, len(b)) if n < len(a))
    inside = any(a != b and a in b for a in names for b in names)
    return None if overlapping or inside else max(map(len, names), default=0) + 2


class Library:
    """Counts whole texts as the public library does."""

    def __init__(self, path: str, raw: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core alone
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_proto=raw)
            self.many = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            return
        from tokenizers import Tokenizer
        t = Tokenizer.from_str(raw.decode())
        t.no_truncation()
        t.no_padding()
        self.many = lambda texts: [len(x) for x in t.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text, a bounded number of characters at a time."""
        out, part, size = [], [], 0
        for t in texts:
            part.append(t)
            size += len(t)
            if size >= AT_ONCE:
                out += self.many(part)
                part, size = [], 0
        return out + (self.many(part) if part else [])


class ByteLevel(Codec):
    """The same for a byte-level tokenizer with a proof: pre-tokens are cut by
    the public pattern, each new one is encoded by the library's model, and how
    many tokens it has is remembered."""

    def __init__(self, path: str, raw: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_str(raw.decode())
        self.model, self.cutter = t.model, t.pre_tokenizer
        self.visible = {b: c for c, b in byte_alphabet().items()}
        self.names = {x["content"] for x in json.loads(raw).get("added_tokens") or ()}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.names))) + ")") if self.names else None
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def sizes(self, words: list[str]) -> list[int]:
        """The tokens of each pre-token."""
        if len(self.known) >= WORDS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        got = list(map(known.get, words))
        if None in got:
            for w in {w for w, n in zip(words, got) if n is None}:
                n = older.get(w)
                known[w] = n or len(self.model.tokenize(w.encode().decode("latin-1").translate(self.visible)))
            got = list(map(known.__getitem__, words))
        return got

    def parts(self, text: str) -> tuple[list[str], list[int]]:
        """The pre-tokens and special strings of a text, and their tokens."""
        if self.special is None or not self.special.search(text):
            words = self.cut(text)
            return words, self.sizes(words)
        words, sizes = [], []
        for p in self.special.split(text):
            if p in self.names:
                words.append(p)
                sizes.append(1)
            elif p:
                cut = self.cut(p)
                words += cut
                sizes += self.sizes(cut)
        return words, sizes

    def count(self, texts: list[str]) -> list[int]:
        return [sum(self.parts(t)[1]) for t in texts]

    def starts(self, text: str) -> tuple[int, np.ndarray, np.ndarray]:
        """Tokens of a chunk, its pre-token starts (characters) and the tokens
        before each."""
        words, sizes = self.parts(text)
        at = np.cumsum([0, *map(len, words)])
        before = np.cumsum([0, *sizes])
        return int(before[-1]), at[:-1], before[:-1]


_COUNTERS: dict[str, Library | ByteLevel] = {}


def _counter(path: str, raw: bytes, proven: bool = True) -> Library | ByteLevel:
    """The worker's counter of this vocabulary, made once."""
    if path not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[path] = (ByteLevel if proven else Library)(path, raw)
    return _COUNTERS[path]


def _chunks(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``row``, ``k`` and the text of each chunk: ``chunk`` characters and the
    ``overlap`` after them; the last chunk goes to the end of the text."""
    last = F.greatest(F.ceil((F.length("text") - overlap) / F.lit(chunk)), F.lit(1)).cast("int") - 1
    held = long.select("row", last.alias("last"), F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0)).alias("p"))
    return (held.select("row", F.posexplode(F.expr(
        f"transform(sequence(0, last), k -> concat(p[k], coalesce(substr(get(p, k + 1), 1, {overlap}), '')))"))
        .alias("k", "text")))


def _level(long: DataFrame, path: str, raw, margin: int, chunk: int, overlap: int) -> DataFrame:
    """``row``, ``n_tokens`` of huge texts; null where neighbours don't align."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _counter(path, raw.value)
        for b in batches:
            out = []
            for row, k, text in zip(*(x.to_pylist() for x in b.columns)):
                n, at, before = c.starts(text)
                # where this chunk starts the next one's region, and where its own region ends
                head, tail = (k > 0) & (at <= overlap), (at >= chunk) & (at <= len(text) - margin)
                out.append((row, k, n, at[head], before[head], at[tail] - chunk, before[tail]))
            row, k, n, *lists = zip(*out) if out else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(row, pa.int64()), pa.array(k, pa.int32()), pa.array(n, pa.int64()),
                 *(pa.array(x, pa.list_(pa.int32())) for x in lists)],
                ["row", "k", "n", "head_at", "head_n", "tail_at", "tail_n"])

    # a number of its own: few bytes of text are much work, so tasks are not merged by bytes
    tasks = int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    arrays = ", ".join(f"{x} array<int>" for x in ("head_at", "head_n", "tail_at", "tail_n"))
    made = shared_table(_chunks(long, chunk, overlap).repartition(tasks, "row", "k")
                        .mapInArrow(run, f"row bigint, k int, n bigint, {arrays}"), "chunk-tokens")
    left = made.select("row", (F.col("k") + 1).alias("k"), "n", "tail_at", "tail_n")
    right = made.where("k > 0").select("row", "k", "head_at", "head_n")
    at = F.array_min(F.array_intersect("tail_at", "head_at"))
    cut = (left.join(right, ["row", "k"]).withColumn("at", at)
           .select("row", F.expr("n - tail_n[array_position(tail_at, at) - 1] + head_n[array_position(head_at, at) - 1]").alias("cut")))
    # a splice that failed has a null cut
    cuts = cut.groupBy("row").agg(F.sum("cut").alias("cut"), F.count_if(F.isnull("cut")).alias("failed"))
    return (made.groupBy("row").agg(F.sum("n").alias("n")).join(cuts, "row", "left")
            .select("row", F.when(F.coalesce("failed", F.lit(0)) == 0, F.col("n") - F.coalesce("cut", F.lit(0))).alias("n_tokens")))


def count_tokens(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_bytes`` (UTF-8),
    ``n_tokens`` as the public library counts them without begin, end or added
    special tokens (``tokenizers`` for .json, ``sentencepiece`` for .model) and
    ``over_limit``.

    Null text counts as empty: no bytes, no tokens.  Texts of up to ``chunk``
    and ``overlap`` characters are encoded whole, longer ones in chunks if the
    tokenizer allows a proof (``proven_margin``).  A text whose neighbours align
    at no width is encoded whole in the end.  Repeated rows and rows without an
    id each have their row; an empty table gives none; other columns are not read.
    """
    with open(vocabulary_path, "rb") as f:
        held = f.read()
    margin = proven_margin(json.loads(held)) if vocabulary_path.endswith(".json") else None
    if margin is not None and not margin < overlap < chunk:
        raise ValueError(f"an overlap lies between {margin} and the chunk")
    raw = docs.sparkSession.sparkContext.broadcast(held)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _counter(vocabulary_path, raw.value, margin is not None)
        for b in batches:
            n = c.count(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())],
                                             ["_id", "n_bytes", "n_tokens"])

    is_long = F.length("_text") > chunk + overlap if margin is not None else F.lit(False)
    size = F.octet_length("_text").cast("bigint").alias("n_bytes")
    out = (rows.where(~is_long).select("_id", size, "_text")
           .mapInArrow(whole, f"_id {kind}, n_bytes bigint, n_tokens bigint"))
    if margin is not None:
        # the number of a row is fixed by the write
        long = shared_table(rows.where(is_long).select(
            F.monotonically_increasing_id().alias("row"), "_id", size, F.col("_text").alias("text")), "long-texts")
        todo, counted = long.select("row", "text"), []
        while not todo.isEmpty():
            found = shared_table(_level(todo, vocabulary_path, raw, margin, chunk, overlap), "long-counts")
            counted.append(found.where("n_tokens is not null"))
            chunk, overlap = WIDER * chunk, WIDER * overlap
            todo = long.join(found.where("n_tokens is null"), "row", "left_semi").select("row", "text")
        for found in counted:
            out = out.unionByName(long.select("row", "_id", "n_bytes").join(found, "row").select("_id", "n_bytes", "n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit).withColumnRenamed("_id", id_col)
