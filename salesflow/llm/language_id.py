"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built.  A document is
parsed from the left into the longest phrases that occur in that text; few
phrases mean a text that is cheap to describe by the language.  The number of
phrases times the bits that name one (the logarithm of the text's length), for
each symbol, is the cost; the cheapest language wins.
"""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm._shared import given
from salesflow.llm.bpe import suffix_automaton

#: Symbols of labelled text, all languages together, and documents sampled (about) for
#: each language (by hash); of a document longer than LONGEST symbols a window of
#: that length, placed by hash, is learned.
SYMBOLS, SAMPLE_DOCS, LONGEST = 200_000, 200, 20_000
#: However many languages share SYMBOLS, each may have so many; one with less
#: text names a phrase at the price of so many, so that it does not win by that.
LEAST = 2_000
#: Symbols for letters: the most frequent ones have their own, all others of the
#: labelled text share CLASSES.  A parse table has under 2 states a symbol and 4
#: bytes for each state and symbol: at most 312 MB for SYMBOLS, and 3 MB for each
#: language at LEAST, whatever the scripts.
LETTERS, CLASSES = 128, 64
#: A parse is cut after so many symbols, for every language alike.
SEGMENT = 256
#: Symbols parsed at once.
AT_ONCE = 1 << 20
UND = "und"
_SHIFT = 28


def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    out = np.zeros(0x110000, bool)
    for c in range(0x110000):
        if chr(c).isalpha():
            out[c] = True
    return out


class Model(NamedTuple):
    languages: list[str]
    alphabet: str  # the letters of the labelled texts with an own symbol, in code point order
    steps: list[np.ndarray]  # by language: state x symbol -> next state, phrases ended above _SHIFT
    bits: np.ndarray  # what naming a phrase costs
    rest: str = ""  # the letters of the labelled texts that share CLASSES symbols

    def n(self) -> int:
        """Symbols for the letters of the labelled texts."""
        return len(self.alphabet) + (CLASSES if self.rest else 0)

    def symbols(self) -> np.ndarray:
        """Symbol of each code point: 0 for what is no letter, 1 to n for the
        alphabet and the classes after it, n + 1 for other letters."""
        out = np.zeros(0x110000, np.int64)
        out[_letters()] = self.n() + 1
        rest = np.array([ord(c) for c in self.rest], np.int64)
        out[rest] = len(self.alphabet) + 1 + rest % CLASSES
        out[[ord(c) for c in self.alphabet]] = np.arange(1, len(self.alphabet) + 1)
        return out


def normalise(text: str | None, table: np.ndarray) -> np.ndarray:
    """Symbols of the lower-cased text, runs of non-letters as one 0."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4")
    s = table[code]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] > 0) | (s[:-1] > 0)
    return s[keep]


def steps(symbols: np.ndarray, n: int) -> np.ndarray:
    """The parse table of one labelled text over symbols 0 to ``n`` + 1 and a
    pad symbol that changes nothing.  A symbol that does not continue the
    phrase ends it and starts the next; a symbol that the text lacks is a
    phrase of its own."""
    go, _, _ = suffix_automaton([symbols.tolist()])
    wide = n + 3
    if len(go) >= 1 << _SHIFT:
        raise ValueError("too much labelled text for a parse table")
    out = np.full((len(go), wide), -1, np.int32)  # a state and two ended phrases fit
    for s, x in enumerate(go):
        if x:
            out[s, list(x)] = list(x.values())
    start = out[0].copy()
    lone = start < 0
    start[lone] = 0
    np.copyto(out, start + ((1 + lone.astype(np.int32)) << _SHIFT), where=out < 0)
    out[0] = start + (lone.astype(np.int32) << _SHIFT)
    out[:, wide - 1] = np.arange(len(go))
    return out


def parse_costs(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Bits a symbol of each text under each language."""
    pad = model.n() + 2
    counts = np.zeros((len(texts), len(model.languages)))
    size = np.array([max(1, len(t)) for t in texts])
    begin, held = [], []

    def flush() -> None:
        if not held:
            return
        rows = np.full((len(held), SEGMENT), pad, np.int32)
        for n, (_, seg) in enumerate(held):
            rows[n, :len(seg)] = seg
        owner = np.array([d for d, _ in held])
        columns = np.ascontiguousarray(rows.T)
        for k, table in enumerate(model.steps):
            wide, flat = table.shape[1], table.ravel()
            state = np.zeros(len(held), np.int64)
            ended = np.zeros(len(held), np.int64)
            low = (1 << _SHIFT) - 1
            for column in columns:
                v = flat.take(state * wide + column)
                ended += v >> _SHIFT
                state = (v & low).astype(np.int64)
            ended += state != 0
            counts[:, k] += np.bincount(owner, ended, len(texts))
        held.clear()
        begin.clear()

    for d, t in enumerate(texts):
        for at in range(0, len(t), SEGMENT):
            held.append((d, t[at:at + SEGMENT]))
            if len(held) * SEGMENT >= AT_ONCE:
                flush()
    flush()
    return counts * model.bits[None, :] / size[:, None]


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Model:
    """Learn from the rows of ``docs`` with a language: for each language whole
    documents (of long ones a window) in the order of a hash until its share of
    ``SYMBOLS``, ``LEAST`` or more, is full.  Every language that a row names is learned.
    Rows that repeat an id count once (its first text), rows without an id by
    their text.  Null languages and texts are left out; without rows nothing is
    learned and every document is ``und``."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    lang = F.col(lang_col).cast("string").alias("_lang")
    draw = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.col(text_col)), F.lit("language"))
    # distinct draws: rows that repeat an id must not leave the others of their language undrawn
    counts = rows.groupBy(lang).agg(F.approx_count_distinct(draw).alias("n")).collect()
    if not counts:
        return Model([], "", [], np.zeros(0))
    parts, most = 1 << 30, max(LEAST, SYMBOLS // len(counts))
    spark = docs.sparkSession
    share = spark.createDataFrame([(r["_lang"], min(parts, parts * SAMPLE_DOCS // max(1, r["n"]) + 1)) for r in counts],
                                  "lang string, share bigint")
    length = min(LONGEST, most)
    room = F.greatest(F.length(text_col) - length, F.lit(0))
    at = F.pmod(F.xxhash64(draw, F.lit("window")), room.cast("bigint") + 1).cast("int")
    window = F.substr(F.col(text_col), at + 1, F.lit(length))
    sample = (rows.select(lang, draw.alias("h"), window.alias("_text"))
              .join(F.broadcast(share), F.col("_lang") == F.col("lang"))
              .where(F.pmod("h", F.lit(parts)) < F.col("share"))
              .groupBy("lang", "h").agg(F.min("_text").alias("text")).collect())
    sample.sort(key=lambda r: (r["h"], r["text"]))
    languages = sorted({r["lang"] for r in sample})
    seen: Counter[str] = Counter()
    for r in sample:
        seen.update(r["text"].lower())
    letters = sorted((c for c in seen if c.isalpha()), key=lambda c: (-seen[c], c))
    alphabet, rest = ("".join(sorted(x)) for x in (letters[:LETTERS], letters[LETTERS:]))
    empty = Model(languages, alphabet, [], np.zeros(0), rest)
    table, made, bits = empty.symbols(), [], []
    drawn: dict[str, list[str]] = {}
    for r in sample:
        drawn.setdefault(r["lang"], []).append(r["text"])
    for lang in languages:
        parts_, size = [], 0
        for text in drawn[lang]:
            if size < most:
                parts_.append(normalise(text + "\n", table))
                size += len(parts_[-1])
        learned = np.concatenate(parts_)[:most]
        made.append(steps(learned, empty.n()))
        bits.append(np.log2(max(LEAST, len(learned))))
    return Model(languages, alphabet, made, np.array(bits), rest)


def predict_languages(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, and ``lang_pred`` (a learned language; ``und``
    if the text is null, has no letter, or nothing was learned), ``score`` (0 to
    1: by what part the winner is cheaper than the next; 1 if there is no
    other, 0 for ``und``) and ``phrase_bits`` (the winner's bits a symbol; null
    for ``und``).  Only the text counts; ties go to the first language in
    order; input columns of these names are replaced."""
    model_of = given(docs.sparkSession, model)
    cache: dict[str, np.ndarray] = {}

    @F.pandas_udf("lang string, score double, bits double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        m = model_of.value
        if "table" not in cache:
            cache["table"] = m.symbols()
        out = []
        for at in range(0, len(texts), 256):
            rows = [normalise(t, cache["table"]) for t in texts.iloc[at:at + 256]]
            costs = parse_costs(m, rows) if m.languages else None
            for n, r in enumerate(rows):
                if costs is None or not (r > 0).any():
                    out.append((UND, 0.0, None))
                    continue
                c = costs[n]
                best = int(c.argmin())
                rest = np.delete(c, best)
                out.append((m.languages[best], float(1 - c[best] / rest.min()) if len(rest) else 1.0, float(c[best])))
        return pd.DataFrame(out, columns=["lang", "score", "bits"])

    return (docs.withColumn("_p", predict(F.col(text_col).cast("string")))
            .withColumn("lang_pred", F.col("_p.lang")).withColumn("score", F.col("_p.score"))
            .withColumn("phrase_bits", F.col("_p.bits")).drop("_p"))
