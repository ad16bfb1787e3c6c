"""Set operations and multi-source consolidation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.functions.numeric import MONEY


def concat(dfs: Iterable[DataFrame | None]) -> DataFrame | None:
    """Union by column name, duplicates kept, missing columns null.
    ``None`` inputs (sources that produced nothing) are skipped; all
    skipped -> ``None``.  Empty frames need no special case: they add no
    rows to a union."""
    out = None
    for df in dfs:
        if df is None:
            continue
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def consolidate(api: DataFrame | None, files: DataFrame | None) -> DataFrame | None:
    """The long consolidated view (date, dimension, valeur, ca, source).

    Sellers come from the API rows, summed per (date, seller); the bare
    ``source`` column of the SQL is made deterministic with ``min``.
    Regions come from the file rows as they are.
    """
    parts = []
    if api is not None:
        parts.append(api.groupBy("date", "vendeur").agg(
            F.sum(F.col("montant").cast(MONEY)).alias("ca"), F.min("source").alias("source"))
            .select("date", F.lit("vendeur").alias("dimension"),
                    F.col("vendeur").alias("valeur"), "ca", "source"))
    if files is not None:
        parts.append(files.select("date", F.lit("region").alias("dimension"),
                                  F.col("region").alias("valeur"),
                                  F.col("ca_region").cast(MONEY).alias("ca"), "source"))
    return concat(parts)


def consolidated_total(consolide: DataFrame, dimension: str = "vendeur") -> DataFrame:
    """Per date Σca for one dimension, and its display text (``N/A``
    when there is no total; ``.0f`` rounds half to even as Python does)."""
    t = consolide.groupBy("date").agg(
        F.sum(F.when(F.col("dimension") == dimension, F.col("ca").cast(MONEY))).alias("_ca"))
    return t.select("date", F.col("_ca").cast("double").alias("ca_total"),
                    F.when(F.col("_ca").isNull() | (F.col("_ca") == 0), F.lit("N/A"))
                     .otherwise(F.format_string("%.0f", F.bround("_ca", 0).cast("double")))
                     .alias("ca_texte"))


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order`` wins (latest load).

    An aggregation, not a window: ``max_by(row, order)`` is folded
    map-side, so a key holding a large share of the rows is reduced to
    one candidate per task before the shuffle.  ``order`` must be a total
    order within a key (nulls rank lowest)."""
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(
        F.max_by(F.struct(*others), F.struct(*[F.col(c) for c in order])).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


def set_difference(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values of ``left[cols]`` absent from ``right[cols]``
    (null-safe, like a Python set difference)."""
    l = left.select(*cols).distinct()
    r = right.select(*cols).distinct()
    cond = None
    for c in cols:
        e = l[c].eqNullSafe(r[c])
        cond = e if cond is None else cond & e
    return l.join(r, cond, "left_anti")
