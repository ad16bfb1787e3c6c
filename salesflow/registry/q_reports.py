"""Reports."""

from salesflow.layout import period, stored_sales
from salesflow.operators import reports as Rp
from salesflow.registry import register
from salesflow.registry._sql import W, snap
from salesflow.registry.q_kpis import _G7_SQL, kpis_final_today
from salesflow.sources.config import config_df
from salesflow.views import OBJECTIFS_SQL, objectifs_regions, ventes

# Region targets for the driver regions (3 of 5 configured; the others
# drop out, as regions outside the reference's configuration do).
REGION_TARGETS = (("AFRICA", "afr", 250000), ("AMERICA", "ame", 200000), ("ASIA", "asi", 150000))
REGION_TARGETS_SQL = "(VALUES ('AFRICA', 'afr', 250000), ('AMERICA', 'ame', 200000), " \
                     "('ASIA', 'asi', 150000)) t(region, code, objectif)"
HISTORY_TARGETS = tuple((r, c, o * 2400) for r, c, o in REGION_TARGETS)
HISTORY_TARGETS_SQL = "(VALUES ('AFRICA', 'afr', 600000000), ('AMERICA', 'ame', 480000000), " \
                      "('ASIA', 'asi', 360000000)) t(region, code, objectif)"


def _targets(spark, rows):
    return config_df(spark, rows, "region string, code string, objectif bigint")


@register("g2_report_by_seller", W + f"""
SELECT vendeur, count(*) AS nb_ventes, CAST(sum(quantite) AS BIGINT) AS unites_vendues,
       CAST(round(sum(montant)) AS DOUBLE) AS ca_total,
       {snap('sum(montant) / count(montant)', 0, even=False)} AS panier_moyen
FROM ventes GROUP BY vendeur ORDER BY ca_total DESC, vendeur""")
def g2_report_by_seller(spark, sf_dir):
    return Rp.report_by_seller(ventes(spark, sf_dir))


@register("g2_from_table", W + f"""
SELECT vendeur, count(*) AS nb_ventes, CAST(sum(quantite) AS BIGINT) AS unites_vendues,
       CAST(round(sum(montant)) AS DOUBLE) AS ca_total,
       {snap('sum(montant) / count(montant)', 0, even=False)} AS panier_moyen
FROM ventes WHERE date BETWEEN '1994-03-15' AND '1995-03-14' GROUP BY vendeur""")
def g2_from_table(spark, sf_dir):
    """The seller report of a year, over the stored sales: its months alone."""
    return Rp.report_by_seller(period(stored_sales(spark, sf_dir), "1994-03-15", "1995-03-14"))


@register("g3_report_by_category", W + f""",
c AS (SELECT categorie, sum(montant) AS ca FROM ventes GROUP BY categorie)
SELECT categorie, CAST(round(ca) AS DOUBLE) AS ca_total,
       {snap('ca * 100 / (SELECT sum(montant) FROM ventes)', 1, even=False)} AS part_pct
FROM c ORDER BY ca_total DESC""")
def g3_report_by_category(spark, sf_dir):
    return Rp.report_by_category(ventes(spark, sf_dir))


@register("g11_history_summary", _G7_SQL + f"""
SELECT CAST(sum(CAST(ca_total AS DECIMAL(18,2))) AS DOUBLE) AS ca_cumule,
       {snap('sum(CAST(taux_marge AS DECIMAL(18,4))) / count(taux_marge)', 1)} AS taux_marge_moyen,
       count(*) AS nb_jours
FROM k""")
def g11_history_summary(spark, sf_dir):
    return Rp.history_summary(kpis_final_today(spark, sf_dir))


@register("i2_history", _G7_SQL + """
SELECT date, ca_total, marge_totale, taux_marge, nb_ventes, top_produit, top_vendeur
FROM k ORDER BY date DESC""")
def i2_history(spark, sf_dir):
    return Rp.history(kpis_final_today(spark, sf_dir),
                      ["date", "ca_total", "marge_totale", "taux_marge", "nb_ventes",
                       "top_produit", "top_vendeur"])


@register("i3_latest_days", _G7_SQL + """
SELECT date, ca_total, nb_ventes, taux_marge, atteinte_obj, statut
FROM k ORDER BY date DESC LIMIT 10""")
def i3_latest_days(spark, sf_dir):
    k = kpis_final_today(spark, sf_dir).select("date", "ca_total", "nb_ventes", "taux_marge",
                                               "atteinte_obj", "statut")
    return Rp.latest_days(k, 10)


_REGION_SQL = """
SELECT {keys} v.region, CAST(sum(montant) AS DOUBLE) AS ca,
       CAST(sum(montant) * 100 AS DOUBLE) / CAST(any_value(t.objectif) AS DOUBLE) AS atteinte,
       CASE WHEN sum(montant) >= any_value(t.objectif) THEN '✓ Atteint'
            WHEN sum(montant) * 100 >= CAST(any_value(t.objectif) AS DECIMAL(30,2)) * 80 THEN '⚠ Proche'
            ELSE '✗ En dessous' END AS statut
FROM ventes v JOIN {targets} ON v.region = t.region
GROUP BY {keys} v.region"""


@register("f1_region_attainment", W + _REGION_SQL.format(keys="date,", targets=REGION_TARGETS_SQL))
def f1_region_attainment(spark, sf_dir):
    return Rp.region_attainment(ventes(spark, sf_dir), _targets(spark, REGION_TARGETS))


@register("f1_from_table", W + _REGION_SQL.format(keys="date,", targets=REGION_TARGETS_SQL))
def f1_from_table(spark, sf_dir):
    return Rp.region_attainment(period(stored_sales(spark, sf_dir)), _targets(spark, REGION_TARGETS))


@register("g12_region_analysis", W + _REGION_SQL.format(keys="", targets=HISTORY_TARGETS_SQL))
def g12_region_analysis(spark, sf_dir):
    return Rp.region_attainment(ventes(spark, sf_dir), _targets(spark, HISTORY_TARGETS), by=None)


@register("f2_region_daily_attainment", W + "," + OBJECTIFS_SQL + f""",
a AS (SELECT date, region, sum(montant) AS ca, count(*) AS n FROM ventes GROUP BY 1, 2)
SELECT o.date, o.region, CAST(o.objectif_region AS DOUBLE) AS objectif_region,
       CAST(coalesce(a.ca, 0) AS DOUBLE) AS ca_region, coalesce(a.n, 0) AS nb_ventes,
       {snap('coalesce(a.ca, 0) * 100 / o.objectif_region', 1)} AS atteinte_pct
FROM objectifs o LEFT JOIN a ON o.date = a.date AND o.region = a.region""")
def f2_region_daily_attainment(spark, sf_dir):
    return Rp.region_daily_attainment(ventes(spark, sf_dir), objectifs_regions(spark, sf_dir))


@register("f3_share_of_total", W + f"""
SELECT region, CAST(sum(montant) AS DOUBLE) AS ca,
       {snap('sum(montant) * 100 / (SELECT sum(montant) FROM ventes)', 1, even=False)} AS part_pct
FROM ventes GROUP BY region""")
def f3_share_of_total(spark, sf_dir):
    """Each group over the grand total (the uncorrelated scalar subquery),
    by region."""
    return Rp.share_of_total(ventes(spark, sf_dir), "region")
