"""Embedding near-dedup: spherical k-means cells, blocked cosine products.

Vectors are compared only under one label.  Equal vectors are one class; a
class is assigned to the cell of its nearest centroid (its home) and sent as a
guest to every cell whose boundary it is close enough to, so that no pair at
or above the threshold is missed.  Inside a cell, blocks of bounded size are
multiplied.  A block pair returns link counts and a spanning forest, never its
pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.llm._shared import shared_table
from salesflow.llm.components import connected_components
from salesflow.llm.simhash import _roots

THRESHOLD = 0.93
#: Classes of a label for each cell, about; a label with fewer is one cell.
CELL_ROWS = 4096
#: Cells in all, at most: what is broadcast is MAX_CELLS centroids.  Beyond,
#: cells hold more rows, and more blocks of BLOCK_ROWS.
MAX_CELLS = 1024
#: Vectors of the bounded sample that k-means is fitted on, for each cell.
SAMPLE_A_CELL = 16
BLOCK_ROWS = 2048
ROUNDS = 8


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """``k`` unit centroids of the unit rows ``x``: farthest-first seeding, then
    mean directions; an empty cell keeps its centroid."""
    seeds, near = [0], x @ x[0]
    while len(seeds) < k:
        seeds.append(int(near.argmin()))
        near = np.maximum(near, x @ x[seeds[-1]])
    c = x[seeds].copy()
    for _ in range(rounds):
        home = (x @ c.T).argmax(1)
        s = np.zeros_like(c)
        np.add.at(s, home, x)
        norm = np.linalg.norm(s, axis=1)
        c[norm > 0] = s[norm > 0] / norm[norm > 0, None]
    return np.unique(c, axis=0)


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)  # no overflow of the squares
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def fit_cells(classes: DataFrame) -> dict:
    """Centroids of the labels with more than ``CELL_ROWS`` classes, fitted on
    a bounded sample by hash (``SAMPLE_A_CELL`` vectors a cell).  At most
    ``MAX_CELLS`` cells are given out, in proportion to the labels' sizes."""
    large = (classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL_ROWS)
             .orderBy(F.desc("n"), "label").limit(MAX_CELLS // 2).collect())
    cells = sum(-(-r["n"] // CELL_ROWS) for r in large)
    scale = min(1.0, MAX_CELLS / cells) if cells else 1.0
    wanted = {r["label"]: max(2, int(-(-r["n"] // CELL_ROWS) * scale)) for r in large}
    if not wanted:
        return {}
    parts = 1 << 30
    share = {r["label"]: min(parts, int(parts * SAMPLE_A_CELL * wanted[r["label"]] / r["n"])) for r in large}
    spark = classes.sparkSession
    shares = spark.createDataFrame(list(share.items()), T.StructType(
        [T.StructField("label", classes.schema["label"].dataType), T.StructField("share", T.LongType())]))
    sample = (classes.join(F.broadcast(shares), "label")
              .where(F.pmod(F.xxhash64("rep"), F.lit(parts)) < F.col("share"))
              .select("label", "rep", "vec").limit(2 * SAMPLE_A_CELL * sum(wanted.values())).toPandas())
    out = {}
    for label, k in wanted.items():
        rows = sample[sample["label"] == label].sort_values("rep")
        if len(rows) > k:
            out[label] = spherical_kmeans(unit(np.stack(rows["vec"].to_numpy())), k)
    return out


def assign_cells(classes: DataFrame, centroids: dict, threshold: float) -> DataFrame:
    """A row for the home of each class and for each cell that it visits:
    ``label``, ``cell``, ``home``, ``visits`` (the cells it visits), ``rep``,
    ``mult``, ``vec``.

    A pair at or above the threshold with homes a and b is at most a chord
    apart, and the plane between a and b crosses that chord, so one of the two
    is within half a chord of the plane: it visits the other's home.
    """
    half = np.sqrt(max(0.0, 2 - 2 * threshold)) / 2 + 1e-9
    given = classes.sparkSession.sparkContext.broadcast(centroids)
    gaps = classes.sparkSession.sparkContext.broadcast(
        {k: np.linalg.norm(c[:, None] - c[None], axis=2) for k, c in centroids.items()})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 4096):
                part = b.iloc[at:at + 4096]
                for label, g in part.groupby("label", sort=False):
                    c = given.value.get(label)
                    if c is None:
                        yield g.assign(cell=0, home=0, visits=[[]] * len(g))
                        continue
                    s = unit(np.stack(g["vec"].to_numpy()).astype(float)) @ c.T
                    home = s.argmax(1)
                    own = s[np.arange(len(g)), home]
                    visit = (own[:, None] - s) <= half * gaps.value[label][home]
                    visit[np.arange(len(g)), home] = False
                    visits = [np.flatnonzero(v).tolist() for v in visit]
                    where = [[h, *v] for h, v in zip(home.tolist(), visits)]
                    yield g.assign(home=home, visits=visits, cell=where).explode("cell")

    kind = classes.schema["label"].dataType.simpleString()
    return classes.select("label", "rep", "mult", "vec").mapInPandas(
        lambda it: (x[["label", "cell", "home", "visits", "rep", "mult", "vec"]] for x in run(it)),
        f"label {kind}, cell int, home int, visits array<int>, rep bigint, mult bigint, vec array<double>")


def compare_blocks(p: pd.DataFrame, cell: int, i: int, j: int, threshold: float) -> pd.DataFrame:
    """Links of the block pair (i, j) of one cell: for each class that has
    any, the rows it links with and the least class of its local group."""
    x = unit(np.stack(p["vec"].to_numpy()).astype(float))
    block, home = p["block"].to_numpy(), p["home"].to_numpy()
    mult, rep = p["mult"].to_numpy(), p["rep"].to_numpy()
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    s = x[left] @ x[right].T
    close = np.abs(s - threshold) < 1e-9
    for a, b in zip(*np.nonzero(close)):  # on the border: the quotient as written
        u, v = np.asarray(p["vec"].iloc[left[a]], float), np.asarray(p["vec"].iloc[right[b]], float)
        s[a, b] = np.dot(u, v) / (np.sqrt(np.dot(u, u)) * np.sqrt(np.dot(v, v)))
    hit = s >= threshold
    if i == j:
        hit &= left[:, None] < right[None, :]
    a, b = np.nonzero(hit)
    a, b = left[a], right[b]
    ha, hb = home[a], home[b]
    stay = (ha == cell) | (hb == cell)  # two guests meet at the home of one of them
    a, b = a[stay], b[stay]
    # a pair of different homes that visit each other meets twice: the lower cell counts it
    keep = np.ones(len(a), bool)
    for n in np.flatnonzero(home[a] != home[b]):
        guest, host = (a[n], b[n]) if home[b[n]] == cell else (b[n], a[n])
        keep[n] = home[guest] not in p["visits"].iloc[host] or cell < home[guest]
    counts = np.bincount(a[keep], mult[b[keep]], len(p)) + np.bincount(b[keep], mult[a[keep]], len(p))
    root = _roots(len(p), a, b)
    some = np.flatnonzero((counts > 0) | (root != np.arange(len(p))))
    return pd.DataFrame({"rep": rep[some], "links": counts[some].astype(np.int64), "with": rep[root[some]]})


def embedding_groups(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                     label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: ``id_col``, ``n_links`` (other rows at cosine
    ``threshold`` or more under the same label), ``component_id`` (the smallest
    id reachable, its own included), ``kept`` (it is that id).

    A null label, a null, empty or zero vector, or one with a null or
    non-finite component links with nothing.  Vectors of another length than
    most of their label's are compared among their own length only.  Repeated
    rows count each other.  An empty table gives no rows.
    """
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    given = rows.select(F.col(id_col).cast("bigint").alias("_id"), F.col(label_col).alias("_label"),
                        vec.alias("_vec"))
    sound = (F.col("_label").isNotNull() & F.col("_vec").isNotNull()
             & F.forall("_vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists("_vec", lambda x: x != 0))
    # equal vectors have equal texts of their components, and a digest of that is short
    same = F.sha2(F.concat_ws(",", F.transform("_vec", lambda x: (x + 0.0).cast("string"))), 256)
    mine = shared_table(
        given.withColumn("sound", F.coalesce(sound, F.lit(False)))
        .select("_id", "_label", "sound", F.when(F.col("sound"), same).alias("same"),
                F.when(F.col("sound"), F.col("_vec")).alias("_vec")), "vectors")
    label = F.struct(F.col("_label").alias("label"), F.size("_vec").alias("size"))
    classes = shared_table(
        mine.where("sound").groupBy(label.alias("label"), "same")
        .agg(F.min("_id").alias("rep"), F.count(F.lit(1)).alias("mult"), F.first("_vec").alias("vec"))
        .select(F.to_json("label").alias("label"), "same", "rep", "mult", "vec"), "classes")
    placed = shared_table(assign_cells(classes, fit_cells(classes), threshold), "cells")

    sizes = placed.groupBy("label", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    sizes = shared_table(sizes, "cell-sizes")
    blocks = (placed.join(sizes, ["label", "cell"])
              .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")))

    def compare(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        return compare_blocks(p, key[1], key[2], key[3], threshold)

    found = shared_table(
        blocks.select("label", "cell", "i", "j", "block", "home", "visits", "rep", "mult", "vec")
        .groupBy("label", "cell", "i", "j").applyInPandas(compare, "rep bigint, links bigint, `with` bigint"), "links")
    counted = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select("rep", "with"), "rep", "with")
    named = shared_table(
        classes.join(counted, "rep", "left")
        .join(parts.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .select("same", F.col("label").alias("_of"),
                (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id")), "named")
    out = mine.select("_id", "same", F.when(F.col("sound"), F.to_json(label)).alias("_of")).join(
        named, ["same", "_of"], "left")
    return out.select(
        F.col("_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "_id").alias("component_id"),
        F.coalesce(F.col("component_id").eqNullSafe(F.col("_id")) | F.col("component_id").isNull(),
                   F.lit(True)).alias("kept"))
