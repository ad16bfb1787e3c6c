"""Phrase collocation mining by best-first branch and bound.

A phrase scores 1000 * a * n / (l * r) at its worst cut: a its count, l and r
the counts of the parts, n all words of the language.  As a is at most l and r,
and no prefix (suffix) is more frequent than its first (last) word, no phrase
scores more than 1000 * n / max(f(first), f(last)).  So the rare words have the
highest bounds and come first: the frontier holds the phrases whose two ends
have a count up to a limit.  Each round counts what lies behind the old limit
and within the new one, growing phrases from frequent pairs, until a language's
last wanted score lies above the bound of all that is not yet expanded.

Counted are all phrases with one end within the limit.  So the parts of every
phrase of the frontier are counted, and so are its extensions by one word,
which decide whether a longer phrase holds it: its other end stays.

Words are 64-bit hashes of language and word, proven free of collisions for
every frequent word (else another seed is taken), and a phrase is the bytes of
its words' hashes: exact keys.  What tasks know of frequent words and pairs is
a table of a fixed number of buckets, which lets too much through at worst.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm._shared import shared_table

LONGEST, LEAST, TOP = 5, 100, 2000
#: The first limit takes in this share of all occurrences of frequent words.
FIRST = 1 / 8
#: Buckets of the tables that tasks get: at most 4,194,304, a few bytes each.
BUCKETS = 1 << 22
#: Bytes of text encoded at once, words of a row, hashes counted at once, and
#: words counted before they leave a task.  Rows are short because Spark sends
#: them by number, not by size.
TEXT_BYTES, ROW_WORDS, AT_ONCE, WORDS_HELD = 1 << 22, 128, 1 << 20, 400_000
#: Phrases in a batch that leaves a task.
SENT = 1 << 15
#: Groups in which a language's best are sought before they meet.
SALTS = 64
OLD, NEW, LATER = 1, 2, 4
_CLEAN = bytes(ord("\n") if chr(b) in ".,;:!?\n\x0b\x0c\r" else ord(" ") if b == 9 else b + 32 if 65 <= b <= 90 else b
               for b in range(256))


def pieces(raw: bytes) -> list[bytes]:
    """The words of a text, A-Z lower-cased; a line feed between pieces."""
    return list(filter(None, raw.translate(_CLEAN).replace(b"\n", b" \n ").split(b" ")))


def word_hash(lang: bytes, word: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(lang + b"\x00" + word, seed) or 1


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of batches, few of them at a time as Python values."""
    for b in batches:
        for at in range(0, b.num_rows, 128):
            yield from zip(*(c.to_pylist() for c in b.slice(at, 128).columns))
        pa.default_memory_pool().release_unused()


def _encoded(docs: DataFrame, text_col: str, lang_col: str, seed: int) -> DataFrame:
    """Rows of two kinds: ``lang``, ``word``, ``code``, ``n`` (counts of a part
    of a task), and ``codes`` (hashes of consecutive words, 0 between pieces)."""
    names = ["lang", "word", "code", "n", "codes"]
    kinds = [pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]

    def batch(**columns) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[c], k) if c in columns else pa.nulls(size, k) for c, k in zip(names, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, Counter] = {}

        def counts() -> Iterator[pa.RecordBatch]:
            for lang, found in total.items():
                words = list(found)
                code = np.array([word_hash(lang.encode(), w, seed) for w in words], np.uint64).view(np.int64)
                for at in range(0, len(words), 50_000):
                    part = words[at:at + 50_000]
                    yield batch(lang=[lang] * len(part), word=part, code=code[at:at + 50_000], n=[found[w] for w in part])
            total.clear()

        def encode(lang: str, texts: list[bytes]) -> pa.RecordBatch | None:
            words = pieces(b"\n".join(texts))
            found = Counter(words)
            found.pop(b"\n", None)
            total.setdefault(lang, Counter()).update(found)
            code = {w: word_hash(lang.encode(), w, seed) for w in found} | {b"\n": 0}
            codes = np.array(list(map(code.__getitem__, words)) + [0], np.uint64)
            if not found:
                return None
            ends = np.flatnonzero(codes == 0) + 1
            # a row ends with the piece that brings it to so many words
            at = np.unique(ends[np.searchsorted(ends, np.arange(ROW_WORDS, len(codes) + ROW_WORDS, ROW_WORDS)).clip(max=len(ends) - 1)])
            raw = codes.tobytes()
            return batch(codes=[raw[a * 8:b * 8] for a, b in zip([0, *at[:-1].tolist()], at.tolist())])

        held: dict[str, list[bytes]] = {}
        size: Counter = Counter()
        for lang, text in _rows(batches):
            held.setdefault(lang, []).append(text)
            size[lang] += len(text)
            if sum(size.values()) >= TEXT_BYTES or len(held) > 1000:
                yield from filter(None, (encode(k, v) for k, v in held.items()))
                held.clear()
                size.clear()
                if sum(map(len, total.values())) >= WORDS_HELD:
                    yield from counts()
        yield from filter(None, (encode(k, v) for k, v in held.items()))
        yield from counts()

    return (docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("raw"))
            .mapInArrow(run, "lang string, word binary, code bigint, n bigint, codes binary"))


def _mix(codes: list[np.ndarray]) -> np.ndarray:
    h = codes[0].copy()
    for c in codes[1:]:
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= c
    return h ^ (h >> np.uint64(32))


def _counted(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of equally long columns, and how often each occurs."""
    h = _mix(codes)
    order = np.argsort(h, kind="stable")
    h = h[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    for c in codes:  # one column at a time, so that no second copy of all rows is held
        c = c[order]
        if ((c[1:] != c[:-1]) & ~new[1:]).any():  # two phrases of one hash
            return np.unique(np.stack(codes, 1), axis=0, return_counts=True)
    first = np.flatnonzero(new)
    at = order[first]
    return np.stack([c[at] for c in codes], 1), np.diff(first, append=len(h))


def _phrases(coded: DataFrame, lengths: range, flags, pairs=None) -> DataFrame:
    """``key``, ``a``: the phrases of these lengths with frequent words whose
    one end is new and whose other end is not old.  ``pairs``: the buckets of
    the frequent pairs; a pair with an end within the limit must be in one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(BUCKETS, np.uint8)
        known[flags.value[0]] = flags.value[1]
        frequent = None
        if pairs is not None:
            frequent = np.zeros(BUCKETS, bool)
            frequent[pairs.value] = True
        part, size = [], 0
        for (r,) in _rows(batches):
            part.append(r)
            size += len(r)
            if size >= 8 * AT_ONCE:
                yield from count(np.frombuffer(b"".join(part), np.uint64), known, frequent)
                part, size = [], 0
        yield from count(np.frombuffer(b"".join(part), np.uint64), known, frequent)

    def count(codes: np.ndarray, known: np.ndarray, frequent: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        flag = known[(codes & np.uint64(BUCKETS - 1)).astype(np.int64)]
        flag[codes == 0] = 0
        new, open_ = (flag & NEW) > 0, (flag & (NEW | LATER)) > 0
        joined = (flag[:-1] > 0) & (flag[1:] > 0)  # the word and the next can stand in a phrase
        if frequent is not None:
            within = (flag & LATER) == 0
            at = np.flatnonzero(joined & (within[:-1] | within[1:]))
            bucket = _mix([codes[at], codes[at + 1]]) & np.uint64(BUCKETS - 1)
            joined[at[~frequent[bucket.astype(np.int64)]]] = False
        run_ = joined.copy()
        for m in range(2, lengths.stop):
            if m > 2:
                run_ = run_[:-1] & joined[m - 2:]
            if m < lengths.start or not len(run_):
                continue
            first, last = slice(None, len(run_)), slice(m - 1, m - 1 + len(run_))
            at = np.flatnonzero(run_ & ((new[first] & open_[last]) | (open_[first] & new[last])))
            if len(at):
                rows, n = _counted([codes[at + j] for j in range(m)])
                for k in range(0, len(rows), SENT):  # the JVM takes a batch in whole
                    data = np.ascontiguousarray(rows[k:k + SENT])
                    ends = np.arange(0, 8 * m * len(data) + 1, 8 * m, dtype=np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)]),
                         pa.array(n[k:k + SENT], pa.int64())], ["key", "a"])

    return coded.mapInArrow(run, "key binary, a bigint").groupBy("key").agg(F.sum("a").alias("a"))


def _pair_buckets(pairs: DataFrame) -> np.ndarray:
    """The buckets that frequent pairs fall in: BUCKETS at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_mix([k[:, 0], k[:, 1]]) & np.uint64(BUCKETS - 1)).astype(np.int64))], ["b"])

    found = pairs.select("key").mapInArrow(run, "b bigint").distinct().toArrow()
    return found.column(0).to_numpy()


def _part(key: str, start: int | str, length: int | str | None = None) -> Column:
    """Words ``start`` (from 0) on of a phrase's key."""
    return F.expr(f"substring({key}, 8 * ({start}) + 1{'' if length is None else f', 8 * ({length})'})")


def _survivors(counts: DataFrame, words: DataFrame, state: DataFrame, longest: int) -> DataFrame:
    """The phrases of the frontier that no longer phrase replaces: ``lang``,
    ``key``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    size = F.expr("octet_length(key) div 8").cast("int")
    counts = counts.withColumn("m", size)
    units = counts.select("key", "a", F.lit(None).cast("string").alias("lang")).unionByName(
        words.select("key", F.col("f").alias("a"), "lang"))
    left = units.select(F.col("key").alias("head"), F.col("a").alias("l"), "lang")
    right = units.select(F.col("key").alias("tail"), F.col("a").alias("r"))
    cuts = (counts.select("key", "a", "m", F.explode(F.expr("sequence(1, m - 1)")).alias("k"))
            .withColumn("head", _part("key", 0, "k")).withColumn("tail", _part("key", "k")))
    scored = (cuts.join(left, "head").join(right, "tail")
              .groupBy("key", "a", "m").agg(F.collect_list(F.struct("k", "l", "r")).alias("cuts"), F.max("lang").alias("lang"))
              .where("size(cuts) = m - 1"))  # at most four cuts; others reach beyond the frontier
    held = (counts.where("m > 2").select("a", F.explode(F.array(_part("key", 0, "m - 1"), _part("key", 1))).alias("key"))
            .groupBy("key").agg(F.max("a").alias("longer")))
    cuts_scored = F.expr(
        "array_min(transform(cuts, c -> struct(cast(1000 as decimal(38, 0)) * a * n div "
        "(cast(c.l as decimal(19, 0)) * cast(c.r as decimal(19, 0))) as score, c.k as k, c.l as l, c.r as r)))")
    return (scored.join(state.where("not done"), "lang")
            .where(F.expr("exists(cuts, c -> c.k = 1 and c.l <= upto) and exists(cuts, c -> c.k = m - 1 and c.r <= upto)"))
            .join(held, "key", "left").where("coalesce(longer, 0) < a")
            .withColumn("best", cuts_scored)
            .select("lang", "key", "a", "best.l", "best.r", "n", "best.score"))


def _best(found: DataFrame, top: int, *order: Column) -> DataFrame:
    """The first ``top`` of each language, ties included, as ``place``: first
    within groups, so that no task holds a whole language."""
    salted = Window.partitionBy("lang", "_salt").orderBy(*order)
    return (found.withColumn("_salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)))
            .withColumn("place", F.rank().over(salted)).where(F.col("place") <= top)
            .withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order)))
            .where(F.col("place") <= top).drop("_salt"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP,
                 longest: int = LONGEST, first: float = FIRST) -> DataFrame:
    """The ``top`` collocations of each language: ``lang``, ``rank``,
    ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Phrases have 2 to ``longest`` words of one piece and occur ``least`` times
    or more; those that a longer phrase of the same count holds are left out.
    Order: score and count falling, then the phrase by bytes.  Null text counts
    as empty, a null language as ``und``; repeated rows count each time; without
    a phrase there is no row; other columns are not read.
    """
    spark = docs.sparkSession
    for seed in range(100):
        coded = shared_table(_encoded(docs, text_col, lang_col, seed), "coded")
        words = shared_table(coded.where("code is not null").groupBy("code").agg(
            F.sum("n").alias("f"), F.min(F.struct("lang", "word")).alias("low"), F.max(F.struct("lang", "word")).alias("high")), "words")
        if words.where((F.col("low") != F.col("high")) & (F.col("f") >= least)).isEmpty():
            break
    words = words.select("code", "f", "low.lang", "low.word")
    coded = coded.where("codes is not null").select("codes")
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    # little-endian, as in the phrases
    key = F.expr("unhex(concat(" + ", ".join(f"substring(lpad(hex(code), 16, '0'), {b}, 2)" for b in range(15, 0, -2)) + "))")
    words = shared_table(words.where(F.col("f") >= least).withColumn("key", key), "frequent")

    scale = F.floor(F.log2("f")).cast("int").alias("scale")
    up = Window.partitionBy("lang").orderBy("scale")  # at most 63 rows a language
    state = shared_table(
        words.groupBy("lang", scale).agg(F.sum("f").alias("s"), F.max("f").alias("most"))
        .withColumn("upto_here", F.sum("s").over(up)).withColumn("all", F.sum("s").over(Window.partitionBy("lang")))
        .groupBy("lang").agg(F.max("most").alias("most"),
                             F.min(F.when(F.col("upto_here") >= first * F.col("all"), F.col("most"))).alias("upto"))
        .join(total, "lang").select("lang", "n", "most", F.lit(0).cast("bigint").alias("before"), "upto", F.lit(False).alias("done")), "state")

    tables, results = [], []
    while not state.where("not done").isEmpty():
        flag = F.when(F.col("f") <= F.col("before"), OLD).when(F.col("f") <= F.col("upto"), NEW).otherwise(LATER)
        found = (words.join(state.where("not done"), "lang")
                 .groupBy(F.col("code").bitwiseAND(BUCKETS - 1).alias("b")).agg(F.bit_or(flag).alias("flag"))).toArrow()
        flags = spark.sparkContext.broadcast((found.column(0).to_numpy(), found.column(1).to_numpy().astype(np.uint8)))
        pairs = shared_table(_phrases(coded, range(2, 3), flags).where(F.col("a") >= least), "pairs")
        tables.append(pairs)
        # pairs of earlier rounds too: a phrase may hold an old word inside
        every = reduce(DataFrame.unionByName, tables).where("octet_length(key) = 16")
        buckets = spark.sparkContext.broadcast(_pair_buckets(every))
        tables.append(shared_table(_phrases(coded, range(3, longest + 1), flags, buckets).where(F.col("a") >= least), "phrases"))
        for b in (flags, buckets):
            b.destroy()
        # a bucket shared by words of two kinds can have a phrase counted, whole, in two rounds
        counts = reduce(DataFrame.unionByName, tables).groupBy("key").agg(F.max("a").alias("a"))
        best = shared_table(_best(_survivors(counts, words, state, longest), top, F.desc("score"), F.desc("a")), "best")
        last = best.groupBy("lang").agg(F.when(F.count(F.lit(1)) >= top, F.min("score")).alias("score"))
        # beyond this count no phrase reaches the last score, not even as a tie
        enough = F.expr("1000 * cast(n as decimal(38, 0)) div score")
        state = shared_table(
            state.where("not done").join(last, "lang", "left").withColumn("need", F.coalesce(enough, "most"))
            .withColumn("done", F.col("upto") >= F.least("need", "most"))
            .select("lang", "n", "most", F.col("upto").alias("before"),
                    F.when(F.col("score").isNotNull(), F.least("need", "most"))
                    .otherwise(F.least(16 * F.col("upto"), F.col("most"))).alias("upto"), "done"), "state")
        results.append(best.join(state.where("done"), "lang", "left_semi"))

    schema = "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint"
    if not results:
        return spark.createDataFrame([], schema)
    best = reduce(DataFrame.unionByName, results)
    spelled = (best.select("key", F.posexplode(F.expr("transform(sequence(0, octet_length(key) div 8 - 1), j -> substring(key, 8 * j + 1, 8))")).alias("at", "word_key"))
               .join(words.select(F.col("key").alias("word_key"), "word"), "word_key")
               .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", F.decode("word", "UTF-8").alias("w")))).alias("w"))
               .select("key", F.array_join("w.w", " ").alias("phrase")))
    out = _best(best.drop("place").join(spelled, "key"), top, F.desc("score"), F.desc("a"), F.asc("phrase"))
    return out.select("lang", F.col("place").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle(least: int = LEAST, top: int = TOP) -> str:
    """The same in SQL, with every phrase counted."""
    grams = "\nUNION ALL ".join(
        f"SELECT lang, {m} AS m, list_slice(w, i, i + {m - 1}) AS p FROM starts WHERE i + {m - 1} <= len(w)" for m in range(1, 6))
    cuts = "\nUNION ALL ".join(
        f"SELECT lang, p, m, a, {k} AS k, list_slice(p, 1, {k}) AS x, list_slice(p, {k + 1}, m) AS y FROM c WHERE m > {k}" for k in range(1, 5))
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
ws AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM ws),
g AS ({grams}),
f AS (SELECT lang, m, p, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE m > 1 AND a >= {least}),
cut AS ({cuts}),
s AS (SELECT cut.lang, cut.p, cut.m, cut.a, k, fx.a AS l, fy.a AS r, n.n,
        CAST(1000 AS HUGEINT) * cut.a * CAST(n.n AS HUGEINT) // (CAST(fx.a AS HUGEINT) * fy.a) AS score
      FROM cut JOIN f fx ON fx.lang = cut.lang AND fx.p = x JOIN f fy ON fy.lang = cut.lang AND fy.p = y
      JOIN n ON n.lang = cut.lang),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
longer AS (SELECT lang, q, max(a) AS a FROM (
    SELECT lang, list_slice(p, 1, m - 1) AS q, a FROM c WHERE m > 2
    UNION ALL SELECT lang, list_slice(p, 2, m) AS q, a FROM c WHERE m > 2) GROUP BY ALL),
kept AS (SELECT best.*, array_to_string(p, ' ') AS phrase FROM best
         LEFT JOIN longer ON longer.lang = best.lang AND longer.q = best.p WHERE coalesce(longer.a, 0) < best.a)
SELECT lang, row_number() OVER w AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY row_number() OVER w <= {top}"""
