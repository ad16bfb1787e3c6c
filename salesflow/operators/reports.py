"""Reports over sales and KPI tables: seller and category reports, share
of total, ratio-of-sums attainment, history, region attainment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.functions.labels import status2, status_region
from salesflow.functions.numeric import MONEY, attainment, ratio
from salesflow.operators._common import By, by_list, group


def report_by_seller(df: DataFrame, by: By = None) -> DataFrame:
    """Per seller nb_ventes, unites_vendues, ROUND(SUM), ROUND(AVG),
    ordered by ca_total desc (ties by seller).  Half-up rounding."""
    keys = by_list(by)
    t = df.groupBy(*keys, "vendeur").agg(
        F.count(F.lit(1)).alias("nb_ventes"),
        F.sum("quantite").cast("bigint").alias("unites_vendues"),
        F.sum(F.col("montant").cast(MONEY)).alias("_ca"),
        F.count("montant").alias("_n"))
    return t.select(*keys, "vendeur", "nb_ventes", "unites_vendues",
                    F.round("_ca", 0).cast("double").alias("ca_total"),
                    ratio("_ca", "_n", scale=0, half_even=False).alias("panier_moyen")) \
            .orderBy(F.desc("ca_total"), "vendeur")


def report_by_category(df: DataFrame, by: By = None) -> DataFrame:
    """Per category ROUND(SUM) and its share (%, 1 digit) of the
    grand total over all rows (computed from the grouped rows, not by a
    second scan of the sales)."""
    keys = by_list(by)
    t = _with_total(df.groupBy(*keys, "categorie").agg(
        F.sum(F.col("montant").cast(MONEY)).alias("_ca")), keys)
    return t.select(*keys, "categorie", F.round("_ca", 0).cast("double").alias("ca_total"),
                    ratio(F.col("_ca"), F.col("_tot"), scale=1, factor=100, half_even=False)
                    .alias("part_pct")).orderBy(F.desc("ca_total"), "categorie")


def _with_total(grouped: DataFrame, keys: list[str]) -> DataFrame:
    """Attach ``_tot`` = Σ``_ca`` over the grouped rows (per ``keys``).

    The total is an aggregate of the grouped rows: a scalar subquery
    (computed once, used as a value) for the grand total, an equi-join on
    ``keys`` otherwise.  No window moves the grouped rows into one
    partition, so any number of groups works."""
    if not keys:
        return grouped.withColumn("_tot", grouped.agg(F.sum("_ca")).scalar())
    tot = grouped.groupBy(*keys).agg(F.sum("_ca").alias("_tot"))
    return grouped.join(tot, keys)


def seller_performance(perf: DataFrame) -> DataFrame:
    """N2 core: per row ``atteinte_obj = round(ca/objectif*100, 1)`` and
    the two-way status on the rounded value (C5 + C7)."""
    return perf.withColumn("atteinte_obj", attainment("ca", "objectif", 1)) \
               .withColumn("statut", status2("atteinte_obj"))


def overall_attainment(perf: DataFrame, by: By = None) -> DataFrame:
    """Σca / Σobjectif × 100 (ratio of sums, not mean of ratios)."""
    return group(perf, by).agg(
        F.sum(F.col("ca").cast(MONEY)).alias("_ca"),
        F.sum(F.col("objectif").cast(MONEY)).alias("_obj")).select(
        *by_list(by), F.col("_ca").cast("double").alias("ca_total"),
        F.col("_obj").cast("double").alias("objectif_total"),
        attainment("_ca", "_obj", 1).alias("atteinte_pct"))


def history_summary(kpis: DataFrame) -> DataFrame:
    """Σ ca_total, mean taux_marge, number of days."""
    return kpis.agg(
        F.sum(F.col("ca_total").cast(MONEY)).cast("double").alias("ca_cumule"),
        ratio(F.sum(F.col("taux_marge").cast("decimal(18,4)")), F.count("taux_marge"), scale=1)
        .alias("taux_marge_moyen"),
        F.count(F.lit(1)).alias("nb_jours"))


def history(kpis: DataFrame, cols=None, key: str = "date") -> DataFrame:
    """The KPI history, newest first."""
    out = kpis.select(*cols) if cols else kpis
    return out.orderBy(F.desc(key))


def latest_days(table: DataFrame, n: int, key: str = "date") -> DataFrame:
    """The ``n`` latest rows by ``key`` (a top-k: the limit is the
    feature; plans as TakeOrderedAndProject, no global sort)."""
    return table.orderBy(F.desc(key)).limit(n)


def region_attainment(sales: DataFrame, targets: DataFrame, by: By = "date") -> DataFrame:
    """Per (date, region) CA against the region's target; regions
    outside the target config drop out.  No broadcast hint on ``targets``
    (region, objectif): a literal configuration frame has exact size
    statistics and is broadcast by the planner; a large targets table is
    shuffle-joined on the region of the (already aggregated) sales."""
    keys = by_list(by)
    agg = sales.groupBy(*keys, "region").agg(F.sum(F.col("montant").cast(MONEY)).alias("_ca"))
    j = agg.join(targets.select("region", "objectif"), "region")
    target = F.col("objectif").cast(MONEY)
    pct = attainment(F.col("_ca"), target, scale=None)
    return j.select(*keys, "region", F.col("_ca").cast("double").alias("ca"),
                    pct.alias("atteinte"), status_region("_ca", target).alias("statut"))


def region_daily_attainment(sales: DataFrame, objectifs: DataFrame) -> DataFrame:
    """daily targets (date, region, objectif_region) left-joined to
    the daily region sales; a target day without sales has ca 0.  Both
    sides are aggregates keyed by (date, region): a shuffle join on the
    key, no broadcast (targets grow with the calendar)."""
    agg = sales.groupBy("date", "region").agg(
        F.sum(F.col("montant").cast(MONEY)).alias("_ca"), F.count(F.lit(1)).alias("nb_ventes"))
    j = objectifs.join(agg, ["date", "region"], "left")
    ca = F.coalesce(F.col("_ca"), F.lit(0).cast(MONEY))
    return j.select("date", "region", F.col("objectif_region").cast("double").alias("objectif_region"),
                    ca.cast("double").alias("ca_region"),
                    F.coalesce(F.col("nb_ventes"), F.lit(0)).alias("nb_ventes"),
                    attainment(ca, F.col("objectif_region").cast(MONEY), 1).alias("atteinte_pct"))


def share_of_total(df: DataFrame, key: str, amount: str = "montant", scale: int = 1) -> DataFrame:
    """per ``key`` the summed amount and its share (%) of the grand
    total."""
    t = _with_total(df.groupBy(key).agg(F.sum(F.col(amount).cast(MONEY)).alias("_ca")), [])
    return t.select(key, F.col("_ca").cast("double").alias("ca"),
                    ratio(F.col("_ca"), F.col("_tot"), scale=scale, factor=100, half_even=False)
                    .alias("part_pct"))
