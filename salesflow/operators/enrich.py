"""Derived columns: line amount, margin, rate, size class, title case,
attainment and statuses, dimension lookups, lineage."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.functions.labels import DEFAULT_EDGES, LABELS_EN, LABELS_FR, bucket
from salesflow.functions.numeric import MONEY, attainment, margin
from salesflow.functions.text import title_case


def line_amount(df: DataFrame, qty: str = "quantite", price: str = "prix",
                out: str = "montant") -> DataFrame:
    """``montant = quantite * unit price`` in decimals."""
    return df.withColumn(out, (F.col(qty).cast("decimal(12,0)") * F.col(price).cast(MONEY))
                         .cast(MONEY))


def with_margin(df: DataFrame, rate: float = 0.42, scale: int = 2, as_int: bool = False,
                amount: str = "montant", out: str = "marge") -> DataFrame:
    """C4: ``round(montant * rate, scale)`` half to even; ``as_int`` casts."""
    return df.withColumn(out, margin(amount, rate, scale, as_int))


def with_const(df: DataFrame, **values) -> DataFrame:
    """Constant columns (rate, source, region, dimension...)."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def with_size_class(df: DataFrame, edges: Sequence[float] = DEFAULT_EDGES,
                    labels: Sequence[str] = LABELS_FR, col: str = "montant",
                    out: str = "taille_vente", na_label: str | None = None) -> DataFrame:
    """Right-closed size classes."""
    return df.withColumn(out, bucket(col, edges, labels, na_label))


def with_segment(df: DataFrame, edges: Sequence[float] = DEFAULT_EDGES,
                 col: str = "montant") -> DataFrame:
    """C6, English label set (monitoring pipeline)."""
    return with_size_class(df, edges, LABELS_EN, col, "segment")


def with_title_case(df: DataFrame, col: str = "vendeur") -> DataFrame:
    """K1 applied to a column."""
    return df.withColumn(col, title_case(col))


def with_lineage(df: DataFrame, source: str | None = None,
                 loaded_at: str = "charge_le") -> DataFrame:
    """Load time stamp and optional source literal."""
    out = df.withColumn(loaded_at, F.current_timestamp())
    return out.withColumn("source", F.lit(source)) if source is not None else out


def enrich_final(df: DataFrame, rate: float = 0.42,
                 edges: Sequence[float] = DEFAULT_EDGES, lineage: bool = True) -> DataFrame:
    """Final-pipeline enrichment: marge (2 digits), taux_marge, taille_vente
    (null outside the bins), charge_le."""
    out = with_size_class(with_margin(df, rate), edges)
    out = out.withColumn("taux_marge", F.lit(rate))
    return with_lineage(out) if lineage else out


def transform_testable(df: DataFrame, rate: float = 0.42,
                       edges: Sequence[float] = DEFAULT_EDGES) -> DataFrame:
    """Step-9 transform: marge, taux_marge, taille_vente, title-cased seller."""
    out = with_size_class(with_margin(df, rate), edges)
    return with_title_case(out.withColumn("taux_marge", F.lit(rate)), "vendeur")


def with_attainment(df: DataFrame, num: str = "ca", den: str = "objectif",
                    out: str = "atteinte_obj", scale: int | None = 1) -> DataFrame:
    """``num / den * 100`` (rounded half-even to ``scale`` or raw)."""
    return df.withColumn(out, attainment(num, den, scale))


def lookup(df: DataFrame, dim: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Dimension lookup by equi-join.  ``how='left'`` keeps rows
    whose key is missing (null attributes, caught by the quality checks);
    ``how='inner'`` drops them.  No broadcast hint: dimensions grow with
    the data, the planner broadcasts only under its size threshold."""
    return df.join(dim, key, how)


def lookup_mod(df: DataFrame, col: str, values: Sequence[str], out: str) -> DataFrame:
    """``values[col % len(values)]`` (Python modulo, never negative)."""
    arr = F.array(*[F.lit(v) for v in values])
    return df.withColumn(out, F.element_at(arr, (F.pmod(F.col(col), F.lit(len(values))) + 1)
                                           .cast("int")))
