"""Daily KPIs (totals, arg-max tops, three KPI variants, empty-day defaults).

Plan shape for the KPI variants: one pass over the sales rows with
GROUPING SETS ((by, produit), (by, vendeur)).  Spark expands each row
into one row per set and pre-aggregates map-side, so a hot date is
folded before the shuffle and the joined input is computed once.  A
second, small aggregation per date derives the totals (sum of the
per-product partial sums) and the tops (``min_by`` over the groups: no
global sort, no window; partial aggregation works.  ``min_by`` keeps a
string in its buffer, so Spark runs this step as a sort-based
aggregate, a local sort of the grouped rows within each task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.functions.labels import FIXED_STATUS_LIMITS, status_fixed, status_vs_target
from salesflow.functions.numeric import MONEY, cents, from_cents, margin, ratio
from salesflow.operators._common import By, by_list, group, top_order


def day_totals(df: DataFrame, by: By = "date", amount: str = "montant") -> DataFrame:
    """G1: CA sum and row count per date."""
    return group(df, by).agg(from_cents(F.sum(cents(amount))).cast("double").alias("ca_total"),
                             F.count(F.lit(1)).alias("nb_ventes"))


def top_by_sum(df: DataFrame, key: str, value: str = "montant", by: By = "date",
               keep_null: bool = False, out: str | None = None) -> DataFrame:
    """Per date, the key with the largest sum of ``value``.

    pandas semantics by default (null keys dropped); ``keep_null=True``
    keeps them as SQL GROUP BY does.  Ties go to the smallest key.
    """
    keys = by_list(by)
    sums = df.groupBy(*keys, key).agg(F.sum(cents(value)).alias("_s"))
    if not keep_null:
        sums = sums.where(F.col(key).isNotNull())
    return group(sums, keys).agg(
        F.min_by(F.col(key), top_order(F.col("_s"), F.col(key))).alias(out or f"top_{key}"))


def _partials(df: DataFrame, by: By, tops: Sequence[str], extra: dict[str, Column]) -> DataFrame:
    """One GROUPING SETS pass: per date and key of each of ``tops`` the sums
    ``_s`` (montant, long cents), ``_n`` (rows), ``_x_<name>`` of ``extra``, and
    ``_g_<key>``, 0 in the rows of that key."""
    keys = by_list(by)
    sets = [keys + [k] for k in tops]
    return (df.groupingSets(sets, *keys, *tops)
            .agg(F.sum(cents("montant")).alias("_s"),
                 F.count(F.lit(1)).alias("_n"),
                 *[e.alias(f"_x_{n}") for n, e in extra.items()],
                 *[F.grouping(k).alias(f"_g_{k}") for k in tops]))


def _totals(first: DataFrame, by: By, tops: Sequence[str], extra: Sequence[str], keep_null: bool,
            money: Sequence[str] = ()) -> DataFrame:
    """Per date, of the partial sums: ``ca`` (sum of montant), ``nb`` (rows), the
    ``extra`` sums and ``top_<key>`` for each key.  Sums named in ``money`` are
    cents and come back as decimals."""
    lead = f"_g_{tops[0]}"
    in_lead = F.col(lead) == 0
    aggs = [from_cents(F.sum(F.when(in_lead, F.col("_s")))).alias("ca"),
            F.coalesce(F.sum(F.when(in_lead, F.col("_n"))), F.lit(0)).alias("nb")]
    aggs += [(from_cents(F.sum(F.when(in_lead, F.col(f"_x_{n}")))) if n in money
              else F.sum(F.when(in_lead, F.col(f"_x_{n}")))).alias(n) for n in extra]
    for k in tops:
        member = F.col(f"_g_{k}") == 0
        if not keep_null:
            member = member & F.col(k).isNotNull()
        aggs.append(F.min_by(F.col(k), F.when(member, top_order(F.col("_s"), F.col(k))))
                    .alias(f"top_{k}"))
    return group(first, by_list(by)).agg(*aggs)


def _one_pass(df: DataFrame, by: By, tops: Sequence[str], extra: dict[str, Column],
              keep_null: bool, money: Sequence[str] = ()) -> DataFrame:
    return _totals(_partials(df, by, tops, extra), by, tops, list(extra), keep_null, money)


def _or_zero(c: str, empty: Column) -> Column:
    return F.when(empty, F.lit(0).cast(MONEY)).otherwise(F.col(c))


def kpis_final(df: DataFrame, objectif: float = 50000, by: By = "date") -> DataFrame:
    """Final-pipeline day KPIs.

    ca and marge are the half-even rounded sums; taux_marge comes from the
    rounded sums (0 when ca <= 0); panier_moyen = ca / rows; attainment
    against ``objectif``; status excellent / bon / faible; without rows
    (``by=None`` on an empty frame) zeros and ``vide``.  Null product
    or seller keys are ignored for the tops.  ``marge`` is taken from the
    frame when present, else computed at 0.42.
    """
    m = F.col("marge") if "marge" in df.columns else margin("montant")
    t = _one_pass(df, by, ["produit", "vendeur"], {"marge": F.sum(cents(m))},
                  keep_null=False, money=["marge"])
    return final_columns(t, objectif, by)


def final_columns(t: DataFrame, objectif: float, by: By = "date") -> DataFrame:
    """The final KPIs of day totals (``ca``, ``marge``, ``nb`` and the tops)."""
    empty = F.col("nb") == 0
    ca = F.bround(_or_zero("ca", empty), 2)
    mg = F.bround(_or_zero("marge", empty), 2)
    obj = F.lit(objectif).cast(MONEY)
    return t.select(
        *by_list(by),
        ca.cast("double").alias("ca_total"),
        mg.cast("double").alias("marge_totale"),
        ratio(mg, ca, scale=1, factor=100, zero_when=ca <= 0).alias("taux_marge"),
        F.col("nb").alias("nb_ventes"),
        ratio(ca, F.col("nb"), scale=2, zero_when=empty).alias("panier_moyen"),
        F.col("top_produit"), F.col("top_vendeur"),
        ratio(ca, obj, scale=1, factor=100).alias("atteinte_obj"),
        status_vs_target(ca, obj, empty).alias("statut"))


def kpis_sql(df: DataFrame, by: By = "date") -> DataFrame:
    """Warehouse day KPIs as the SQL report computes them: half-up
    rounding, margin rate from the raw sums, null keys kept for the tops
    (ranked after non-null keys), ties -> smallest key."""
    t = _one_pass(df, by, ["produit", "vendeur"], {"marge": F.sum(cents("marge"))},
                  keep_null=True, money=["marge"])
    return t.select(
        *by_list(by),
        F.round(F.col("ca"), 2).cast("double").alias("ca_total"),
        F.round(F.col("marge"), 2).cast("double").alias("marge_totale"),
        ratio(F.col("marge"), F.col("ca"), scale=1, factor=100, half_even=False)
        .alias("taux_marge"),
        F.col("nb").alias("nb_ventes"),
        F.col("top_produit"), F.col("top_vendeur"))


def kpis_basic(df: DataFrame, by: By = "date") -> DataFrame:
    """Step-9 day KPIs: panier_moyen is the mean of the non-null
    amounts (not CA / rows); zeros without rows."""
    t = _one_pass(df, by, ["produit", "vendeur"],
                  {"n_montant": F.count(F.col("montant"))}, keep_null=False)
    empty = F.col("nb") == 0
    return t.select(
        *by_list(by),
        F.bround(_or_zero("ca", empty), 2).cast("double").alias("ca_total"),
        F.col("nb").alias("nb_ventes"),
        ratio(F.col("ca"), F.col("n_montant"), scale=2, zero_when=empty).alias("panier_moyen"),
        F.col("top_produit"), F.col("top_vendeur"))


# Defaults of an empty day (fixed values from the reference).
EMPTY_DEFAULTS = {"ca_total": 0.0, "marge_totale": 0.0, "taux_marge": 0.0,
                  "nb_ventes": 0, "panier_moyen": 0.0, "atteinte_obj": 0.0,
                  "statut": "vide"}


def with_empty_defaults(kpis: DataFrame, calendar: DataFrame, key: str = "date",
                        defaults: dict | None = None) -> DataFrame:
    """One row per calendar date; dates without sales get the empty-
    day defaults (zeros, null tops, ``statut = 'vide'``).  The calendar is
    a one-column frame of dates (bounded by the number of days)."""
    defaults = EMPTY_DEFAULTS if defaults is None else defaults
    joined = calendar.select(key).distinct().join(kpis, key, "left")
    cols = []
    for c in kpis.columns:
        if c == key:
            cols.append(F.col(key))
        elif c in defaults:
            cols.append(F.coalesce(F.col(c), F.lit(defaults[c])).alias(c))
        else:
            cols.append(F.col(c))
    return joined.select(*cols)


def calendar_between(df: DataFrame, key: str = "date") -> DataFrame:
    """Every day from the first to the last date of ``df``, as text.

    Only the min and max travel; ``explode(sequence)`` builds the days in
    one small task, bounded by the calendar length."""
    bounds = df.agg(F.min(F.to_date(key)).alias("lo"), F.max(F.to_date(key)).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("_d"))
    return days.select(F.date_format("_d", "yyyy-MM-dd").alias(key))


def consolidated_kpis(df: DataFrame, by: By = "date", amount: str = "ca",
                      limits: tuple = FIXED_STATUS_LIMITS) -> DataFrame:
    """ca_total (integer part of the sum), nb_vendeurs = rows, status
    on strict fixed limits; no row at all (``by=None``): zeros and ``vide``."""
    t = group(df, by).agg(F.sum(F.col(amount).cast(MONEY)).alias("ca"),
                          F.count(F.lit(1)).alias("nb_vendeurs"))
    empty = F.col("nb_vendeurs") == 0
    ca_int = _or_zero("ca", empty).cast("bigint")
    return t.select(*by_list(by), ca_int.alias("ca_total"), "nb_vendeurs",
                    status_fixed(ca_int, empty, limits=limits).alias("statut"))
