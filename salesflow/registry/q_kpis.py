"""Daily KPIs."""

from pyspark.sql import functions as F

from salesflow.layout import period, stored_sales
from salesflow.operators import kpis as K
from salesflow.operators.enrich import enrich_final, with_margin
from salesflow.registry import register
from salesflow.registry._sql import EDGES, OBJECTIF, W, snap, top_sql
from salesflow.views import ventes

CONSOLIDATED_LIMITS = (1200000, 800000)

_G7_SQL = W + f""",
e AS (SELECT *, round_even(montant * 0.42, 2) AS marge FROM ventes),
d AS (SELECT date, round_even(sum(montant), 2) AS ca, round_even(sum(marge), 2) AS mg,
             count(*) AS nb FROM e GROUP BY date),
k AS (
SELECT d.date, CAST(ca AS DOUBLE) AS ca_total, CAST(mg AS DOUBLE) AS marge_totale,
       CASE WHEN ca <= 0 THEN 0.0 ELSE {snap('mg * 100 / ca', 1)} END AS taux_marge,
       nb AS nb_ventes, {snap('ca / nb', 2)} AS panier_moyen,
       tp.top_produit, tv.top_vendeur,
       {snap(f'ca * 100 / {OBJECTIF}', 1)} AS atteinte_obj,
       CASE WHEN ca >= {OBJECTIF} THEN 'excellent' WHEN ca >= {OBJECTIF} * 0.8 THEN 'bon'
            ELSE 'faible' END AS statut
FROM d LEFT JOIN {top_sql('e', 'produit')} tp USING (date)
       LEFT JOIN {top_sql('e', 'vendeur')} tv USING (date))"""


def kpis_final_today(spark, sf_dir):
    v = ventes(spark, sf_dir)
    return K.kpis_final(enrich_final(v, edges=EDGES, lineage=False), objectif=OBJECTIF)


@register("g7_kpis_final", _G7_SQL + "\nSELECT * FROM k")
def g7_kpis_final(spark, sf_dir):
    return kpis_final_today(spark, sf_dir)


@register("g7_from_table", _G7_SQL + "\nSELECT * FROM k")
def g7_from_table(spark, sf_dir):
    """The flagship over the stored sales: one scan, no join."""
    return K.kpis_final(enrich_final(period(stored_sales(spark, sf_dir)), edges=EDGES, lineage=False), objectif=OBJECTIF)


@register("g1_day_totals", W + """
SELECT date, CAST(sum(montant) AS DOUBLE) AS ca_total, count(*) AS nb_ventes
FROM ventes GROUP BY date""")
def g1_day_totals(spark, sf_dir):
    return K.day_totals(ventes(spark, sf_dir))


@register("g5_top_by_sum", W + f"""
SELECT tp.date, tp.top_produit, tv.top_vendeur
FROM {top_sql('ventes', 'produit')} tp JOIN {top_sql('ventes', 'vendeur')} tv USING (date)""")
def g5_top_by_sum(spark, sf_dir):
    v = ventes(spark, sf_dir)
    return K.top_by_sum(v, "produit").join(K.top_by_sum(v, "vendeur"), "date")


def g6_sql(src: str) -> str:
    """SELECT of the SQL day KPIs over ``src`` (rows with a marge)."""
    return f"""
SELECT d.date, CAST(round(sum(montant), 2) AS DOUBLE) AS ca_total,
       CAST(round(sum(marge), 2) AS DOUBLE) AS marge_totale,
       {snap('sum(marge) * 100 / sum(montant)', 1, even=False)} AS taux_marge,
       count(*) AS nb_ventes, any_value(tp.top_produit) AS top_produit,
       any_value(tv.top_vendeur) AS top_vendeur
FROM {src} d LEFT JOIN {top_sql(src, 'produit', keep_null=True)} tp USING (date)
         LEFT JOIN {top_sql(src, 'vendeur', keep_null=True)} tv USING (date)
GROUP BY d.date"""


@register("g6_kpis_sql", W + """,
e AS (SELECT *, round_even(montant * 0.42, 2) AS marge FROM ventes)""" + g6_sql("e"))
def g6_kpis_sql(spark, sf_dir):
    return K.kpis_sql(with_margin(ventes(spark, sf_dir)))


@register("g8_kpis_basic", W + f"""
SELECT d.date, CAST(round_even(sum(montant), 2) AS DOUBLE) AS ca_total, count(*) AS nb_ventes,
       {snap('sum(montant) / count(montant)', 2)} AS panier_moyen,
       any_value(tp.top_produit) AS top_produit, any_value(tv.top_vendeur) AS top_vendeur
FROM ventes d LEFT JOIN {top_sql('ventes', 'produit')} tp USING (date)
              LEFT JOIN {top_sql('ventes', 'vendeur')} tv USING (date)
GROUP BY d.date""")
def g8_kpis_basic(spark, sf_dir):
    return K.kpis_basic(ventes(spark, sf_dir))


@register("g9_empty_defaults", _G7_SQL + """,
cal AS (SELECT strftime(CAST(d AS DATE), '%Y-%m-%d') AS date FROM (
        SELECT unnest(generate_series(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP),
                                      INTERVAL 1 DAY)) AS d FROM ventes))
SELECT cal.date, coalesce(ca_total, 0.0) AS ca_total, coalesce(marge_totale, 0.0) AS marge_totale,
       coalesce(taux_marge, 0.0) AS taux_marge, coalesce(nb_ventes, 0) AS nb_ventes,
       coalesce(panier_moyen, 0.0) AS panier_moyen, top_produit, top_vendeur,
       coalesce(atteinte_obj, 0.0) AS atteinte_obj, coalesce(statut, 'vide') AS statut
FROM cal LEFT JOIN k USING (date)""")
def g9_empty_defaults(spark, sf_dir):
    k = kpis_final_today(spark, sf_dir)
    return K.with_empty_defaults(k, K.calendar_between(k))


_REGION_SELLER_SQL = """
rv AS (SELECT date, region, vendeur, sum(montant) AS ca FROM ventes GROUP BY date, region, vendeur)"""


@register("g13_consolidated_kpis", W + "," + _REGION_SELLER_SQL + f"""
SELECT date, CAST(trunc(sum(ca)) AS BIGINT) AS ca_total, count(*) AS nb_vendeurs,
       CASE WHEN trunc(sum(ca)) > {CONSOLIDATED_LIMITS[0]} THEN 'excellent'
            WHEN trunc(sum(ca)) > {CONSOLIDATED_LIMITS[1]} THEN 'bon' ELSE 'faible' END AS statut
FROM rv GROUP BY date""")
def g13_consolidated_kpis(spark, sf_dir):
    rv = ventes(spark, sf_dir).groupBy("date", "region", "vendeur").agg(
        F.sum("montant").alias("ca"))
    return K.consolidated_kpis(rv, limits=CONSOLIDATED_LIMITS)


@register("i4_top1_sql", W + f"""
SELECT tp.date, tp.top_produit, tv.top_vendeur
FROM {top_sql('ventes', 'produit', keep_null=True)} tp
JOIN {top_sql('ventes', 'vendeur', keep_null=True)} tv USING (date)""")
def i4_top1_sql(spark, sf_dir):
    """Top-1 by grouped sum as the SQL subquery computes it: null keys
    kept (ranked after the others), ties -> smallest key."""
    v = ventes(spark, sf_dir)
    return K.top_by_sum(v, "produit", keep_null=True).join(
        K.top_by_sum(v, "vendeur", keep_null=True), "date")


@register("g9_empty_frame", """
SELECT 'final' AS variante, 0.0 AS ca_total, 0 AS nb_ventes, 0.0 AS panier_moyen, 'vide' AS statut
UNION ALL SELECT 'basique', 0.0, 0, 0.0, NULL
UNION ALL SELECT 'sql', NULL, 0, NULL, NULL
UNION ALL SELECT 'consolide', 0.0, 0, NULL, 'vide'""")
def g9_empty_frame(spark, sf_dir):
    """The KPI functions of one run without any sale (amounts below zero)."""
    none = with_margin(ventes(spark, sf_dir).where(F.col("montant") < 0))
    null = F.lit(None)

    def row(name, k, basket, status):
        return k.select(F.lit(name).alias("variante"), F.col("ca_total").cast("double").alias("ca_total"),
                        F.col(k.columns[1] if name == "consolide" else "nb_ventes").alias("nb_ventes"),
                        (F.col("panier_moyen") if basket else null.cast("double")).alias("panier_moyen"),
                        (F.col("statut") if status else null.cast("string")).alias("statut"))
    return (row("final", K.kpis_final(none, OBJECTIF, by=None), True, True)
            .unionByName(row("basique", K.kpis_basic(none, by=None), True, False))
            .unionByName(row("sql", K.kpis_sql(none, by=None), False, False))
            .unionByName(row("consolide", K.consolidated_kpis(none, by=None, amount="montant"), False, True)))
