"""Reconciliation by content: order-free, mergeable digests of days.

Equal counts do not mean equal rows.  A day's digest is its number of rows and
the exact sums of two 64-bit hashes of each row.  Sums do not depend on the
order of rows, count a repeated row as often as it occurs, fold map-side (a day
that holds a third of all rows is one row per task) and add up: the digest of
several loads is the sum of theirs.  Layers are compared by their digests, one
row a day; rows are read again only for the days that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.operators._common import By, by_list, group
from salesflow.operators.quality import _stop

MSG_DIFFERENT = "Couches différentes"
#: The sums hold up to 10^10 rows of a group; beyond that they fail, never wrap.
_HASH = "decimal(20,0)"
_PARTS = ("nb", "somme_1", "somme_2")


def _hashes(cols: Sequence[str]) -> list[Column]:
    """Two hashes of a row.  Spark's hash passes over nulls, so which columns
    are null is hashed as well: a value that moves to a null neighbour counts."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), F.lit("0")).otherwise(F.lit("1")) for c in cols])
    return [F.xxhash64(F.lit(seed), nulls, *cols).cast(_HASH) for seed in (1, 2)]


def day_digests(df: DataFrame, by: By = "date", cols: Sequence[str] | None = None) -> DataFrame:
    """Per date: ``nb`` rows and the sums ``somme_1``, ``somme_2`` over the
    columns ``cols`` (all by default; their order and types matter)."""
    cols = list(cols or df.columns)
    first, second = _hashes(cols)
    return group(df, by).agg(F.count(F.lit(1)).alias("nb"), F.sum(first).alias("somme_1"), F.sum(second).alias("somme_2"))


def merge_digests(*digests: DataFrame, by: By = "date") -> DataFrame:
    """The digests of all loads together, from the digests of each."""
    every = digests[0]
    for d in digests[1:]:
        every = every.unionByName(d)
    return group(every, by).agg(*[F.sum(F.col(c)).cast(digests[0].schema[c].dataType).alias(c) for c in _PARTS])


def _aligned(df: DataFrame, like: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).cast(like.schema[c].dataType).alias(c) for c in cols])


def reconcile_content(layers: dict[str, DataFrame], by: By = "date", cols: Sequence[str] | None = None,
                      stop: bool = False, path: str | None = None) -> DataFrame:
    """E10 by content: per date the rows of each layer (0 when absent) and
    ``identique``: whether all layers hold the same rows, as often.

    Compared are ``cols`` (those of the first layer by default), cast to the
    types they have there.  A null date is a group of its own.  ``stop`` writes
    the dates that differ and raises."""
    keys, names = by_list(by), list(layers)
    like = layers[names[0]]
    cols = list(cols or like.columns)
    every = None
    for name, df in layers.items():
        d = day_digests(_aligned(df, like, [*dict.fromkeys([*keys, *cols])]), keys, cols).withColumn("_layer", F.lit(name))
        every = d if every is None else every.unionByName(d)
    # a row per date and layer: each part of each layer is one value
    held = group(every, keys).agg(*[F.max(F.when(F.col("_layer") == n, F.struct(*_PARTS))).alias(f"_{i}")
                                    for i, n in enumerate(names)])
    same = F.lit(True)
    for i in range(1, len(names)):
        same = same & F.col(f"_{i}").eqNullSafe(F.col("_0"))
    out = held.select(*keys, *[F.coalesce(F.col(f"_{i}.nb"), F.lit(0)).alias(f"nb_{n}") for i, n in enumerate(names)],
                      same.alias("identique"))
    if stop:
        _stop(out.where("not identique"), MSG_DIFFERENT, path)
    return out


def content_differences(left: DataFrame, right: DataFrame, by: str = "date", cols: Sequence[str] | None = None) -> DataFrame:
    """The rows that two layers do not share: ``cols`` and ``ecart``, how many
    more of that row ``left`` has (negative: ``right``).

    Only rows of days whose digests differ meet in a shuffle."""
    cols = [*dict.fromkeys([by, *(cols or left.columns)])]
    right = _aligned(right, left, cols)
    days = reconcile_content({"l": left, "r": right}, by, cols).where("not identique").select(F.col(by).alias("_day"))

    def rows(df: DataFrame, sign: int) -> DataFrame:
        mine = df.select(*cols)
        return mine.join(days, mine[by].eqNullSafe(days["_day"]), "left_semi").withColumn("ecart", F.lit(sign))

    return (rows(left, 1).unionByName(rows(right, -1)).groupBy(*cols)
            .agg(F.sum("ecart").alias("ecart")).where("ecart <> 0"))
