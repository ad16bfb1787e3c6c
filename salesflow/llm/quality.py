"""Quality classifier: random Fourier features and ridge, then isotonic.

Statistics of the whole text are standardised and mapped to random Fourier
features, which approximate a Gaussian kernel.  Each partition of the training
rows adds up its part of the normal equations; the sums are solved for ridge
weights.  Pool-adjacent-violators on a held part of the training rows maps raw
scores to probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm._shared import given, shared_table

#: The bounded sample of labelled rows that the model is fitted on (by hash of
#: the id), and the partitions whose sums reach the driver.
SAMPLE_ROWS, SUM_PARTITIONS = 20_000, 8
FEATURES, GAMMA, RIDGE, SEED = 384, 0.01, 1.0, 7
#: One in so many sampled rows is for the calibration alone.
CALIBRATE = 4
THRESHOLD = 0.3

STATISTICS = (
    "log_bytes", "log_words", "letters", "upper", "digits", "spaces", "newlines", "marks", "high_bytes",
    "kinds_of_marks", "mark_entropy", "byte_entropy", "doubled_marks", "doubled_letters", "word_length", "word_length_spread",
    "distinct_words", "top_word", "repeated_word", "words_ending_in_mark", "upper_words", "one_letter_words",
    "lines_a_word", "line_length", "distinct_lines", "short_lines", "sentence_words")

_CLASS = np.zeros(256, np.int8)  # 0 mark, 1 lower, 2 upper, 3 digit, 4 space, 5 newline, 6 high, 7 control
_CLASS[:32], _CLASS[127] = 7, 7
_CLASS[[9, 11, 12, 13, 32]], _CLASS[10] = 4, 5
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123], _CLASS[128:] = 3, 2, 1, 6


def statistics(text: str | None) -> np.ndarray:
    """The document statistics of a whole text, finite for any text; null
    counts as empty, which gives zeros."""
    out = np.zeros(len(STATISTICS))
    raw = (text or "").encode("utf-8", "replace")
    if not raw:
        return out
    b = np.frombuffer(raw, np.uint8)
    n = len(b)
    count = np.bincount(b, minlength=256)
    kind = np.bincount(_CLASS, count, 8)
    marks = count[(_CLASS == 0)]
    cls = _CLASS[b]
    same = b[1:] == b[:-1]
    words = raw.split()
    w = max(1, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    seen: dict[bytes, int] = {}
    for x in words:
        seen[x] = seen.get(x, 0) + 1
    lines = raw.split(b"\n")
    ends = np.flatnonzero((cls[:-1] == 0) & ((cls[1:] == 4) | (cls[1:] == 5)))
    upper = cls == 2
    p = count[count > 0] / n
    q = marks[marks > 0] / max(1, marks.sum())
    stops = count[46] + count[33] + count[63]
    out[:] = (
        np.log1p(n), np.log1p(len(words)), (kind[1] + kind[2] + kind[6]) / n, kind[2] / n, kind[3] / n, kind[4] / n,
        kind[5] / n, kind[0] / n, kind[6] / n, (marks > 0).sum() / 16, -(q * np.log(q)).sum() if len(q) else 0.0,
        -(p * np.log(p)).sum(), (same & (cls[1:] == 0)).sum() / n, (same & (cls[1:] < 3) & (cls[1:] > 0)).sum() / n,
        size.mean(), size.std(), len(seen) / w, max(seen.values(), default=0) / w,
        sum(x == y for x, y in zip(words, words[1:])) / w, len(ends) / w,
        (upper[1:] & upper[:-1]).sum() / n, (size == 1).mean(),
        len(lines) / w, np.log1p(n / len(lines)), len(set(lines)) / len(lines),
        sum(len(x) < 20 for x in lines) / len(lines), np.log1p(w / (1 + stops)))
    return out


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    wave: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    raw: np.ndarray  # rising; calibrated to
    level: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for rows of statistics."""
        s = fourier((x - self.mean) / self.scale, self.wave, self.phase) @ self.weights
        return np.clip(np.interp(s, self.raw, self.level), 0.0, 1.0)


def fourier(z: np.ndarray, wave: np.ndarray, phase: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised rows, and a constant."""
    z = np.clip(z, -6.0, 6.0)
    return np.hstack([np.sqrt(2.0 / len(phase)) * np.cos(z @ wave + phase), np.ones((len(z), 1))])


def isotonic(s: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: block means of ``y`` over ``s``, rising."""
    order = np.argsort(s, kind="stable")
    blocks: list[list[float]] = []  # sum of y, rows, sum of s
    for a, b in zip(s[order].tolist(), y[order].tolist()):
        blocks.append([b, 1.0, a])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


def with_statistics(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """``_id``, ``x`` (the statistics) and the columns ``more``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.drop(columns="_text").assign(x=[statistics(t) for t in b["_text"]])[["_id", "x", *more]]

    kinds = {c: docs.schema[c].dataType.simpleString() for c in more}
    schema = ", ".join([f"_id {docs.schema[id_col].dataType.simpleString()}", "x array<double>",
                        *(f"`{c}` {k}" for c, k in kinds.items())])
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *more).mapInPandas(run, schema)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on the documents that ``labels`` (``id_col``, ``label_col`` 0 or 1)
    names, on ``sample_rows`` of them at most, chosen by hash of the id.

    Null labels and ids are left out; of several labels of an id the mean
    counts, of several texts the one with the least statistics.  Without any
    labelled row every score is 0.5.
    """
    chosen = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(id_col).alias("_of")).agg(F.avg(F.col(label_col).cast("double")).alias("_y"))
              .orderBy(F.xxhash64("_of"), "_of").limit(sample_rows))
    # bounded by sample_rows, so it can be broadcast: texts are not shuffled
    rows = docs.join(F.broadcast(chosen), F.col(id_col) == F.col("_of")).select(id_col, text_col, "_y")
    rows = shared_table(
        with_statistics(rows, id_col, text_col, "_y").groupBy("_id", "_y").agg(F.min("x").alias("x"))
        .withColumn("_hold", F.pmod(F.xxhash64("_id", F.lit(SEED)), F.lit(CALIBRATE)) == 0)
        .withColumn("_part", F.pmod(F.xxhash64("_id", F.lit(SEED + 1)), F.lit(SUM_PARTITIONS)).cast("int")), "training")
    k = len(STATISTICS)
    moments = rows.select(*(f for i in range(k) for f in (
        F.avg(F.col("x")[i]).alias(f"m{i}"), F.stddev_pop(F.col("x")[i]).alias(f"s{i}")))).first()
    mean = np.array([moments[f"m{i}"] or 0.0 for i in range(k)])
    scale = np.array([moments[f"s{i}"] or 0.0 for i in range(k)])
    scale[scale < 1e-9] = 1.0
    rng = np.random.default_rng(SEED)
    wave = rng.normal(0.0, np.sqrt(2 * GAMMA), (k, FEATURES))
    phase = rng.uniform(0.0, 2 * np.pi, FEATURES)

    def features(p: pd.DataFrame) -> np.ndarray:
        return fourier((np.stack(p["x"].to_numpy()) - mean) / scale, wave, phase)

    def sums(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("_id")
        f = features(p)
        return pd.DataFrame({"g": [(f.T @ f).ravel()], "h": [f.T @ p["_y"].to_numpy()], "n": [len(p)]})

    parts = rows.where("not _hold").groupBy("_part").applyInPandas(sums, "g array<double>, h array<double>, n bigint").collect()
    d = FEATURES + 1
    total = sum(p["n"] for p in parts)
    if not total:
        return Model(mean, scale, wave, phase, np.zeros(d), np.array([0.0]), np.array([0.5]))
    g = sum(np.array(p["g"]).reshape(d, d) for p in parts)
    h = sum(np.array(p["h"]) for p in parts)
    weights = np.linalg.solve(g + RIDGE * np.eye(d), h)

    held = rows.where("_hold").select("_id", "x", "_y").toPandas().sort_values("_id")  # of the bounded sample
    if not len(held):
        return Model(mean, scale, wave, phase, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    raw, level = isotonic(features(held) @ weights, held["_y"].to_numpy())
    return Model(mean, scale, wave, phase, weights, raw, level)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs``, and ``score`` (double, 0 to 1), ``predicted``
    (1 if the score reaches ``threshold``).  The score depends on the text
    alone; null and empty texts are scored as texts without words; an empty
    table gives no rows; input columns of these names are replaced."""
    model_of = given(docs.sparkSession, model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(model_of.value.score(np.stack([statistics(t) for t in texts])))

    return (docs.withColumn("score", score(F.col(text_col).cast("string")))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
