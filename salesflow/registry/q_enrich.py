"""Projections, derived columns, routing."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from salesflow.functions import labels as L
from salesflow.functions.numeric import MONEY, attainment
from salesflow.operators import enrich as En
from salesflow.operators import routing as R
from salesflow.operators.reports import overall_attainment, seller_performance
from salesflow.registry import register
from salesflow.registry._sql import EDGES, OBJECTIF, SEUIL, W, WB, bucket_sql, snap
from salesflow.views import lines, products, table, ventes, ventes_brutes

ROUTE_LIMITS = (1200000, 800000)
FIXED_LIMITS = (1200000, 800000)
KEYS = ("date", "l_orderkey", "l_linenumber")


def seller_years(spark, sf_dir):
    """Seller performance rows (vendeur, annee, ca, objectif): the target
    of a year is the seller's CA of the year before.  One pass: the
    yearly aggregate, then a range frame of exactly ``annee - 1`` per
    seller (a handful of rows per seller after aggregation); years
    without a previous year have no target and are left out."""
    y = ventes(spark, sf_dir).groupBy("vendeur", F.substring("date", 1, 4).alias("annee")) \
        .agg(F.sum("montant").alias("ca"))
    prev_year = Window.partitionBy("vendeur").orderBy(F.col("annee").cast("int")) \
        .rangeBetween(-1, -1)
    return y.withColumn("objectif", F.sum("ca").over(prev_year)) \
        .where(F.col("objectif").isNotNull())


SELLER_YEARS_SQL = W + """,
y AS (SELECT vendeur, substr(date, 1, 4) AS annee, sum(montant) AS ca FROM ventes GROUP BY 1, 2),
perf AS (SELECT y.vendeur, y.annee, y.ca, p.ca AS objectif FROM y
         JOIN y p ON p.vendeur = y.vendeur AND CAST(p.annee AS INTEGER) + 1 = CAST(y.annee AS INTEGER))"""


@register("c1_select", W + """
SELECT date, produit, vendeur, CAST(montant AS DOUBLE) AS montant, l_orderkey, l_linenumber
FROM ventes""")
def c1_select(spark, sf_dir):
    return ventes(spark, sf_dir).select("date", "produit", "vendeur",
                                        F.col("montant").cast("double").alias("montant"),
                                        "l_orderkey", "l_linenumber")


@register("c2_with_const", W + """
SELECT date, l_orderkey, l_linenumber, 0.42::DOUBLE AS taux_marge,
       'SOURCE_PRINCIPALE' AS source FROM ventes""")
def c2_with_const(spark, sf_dir):
    v = ventes(spark, sf_dir).select(*KEYS)
    return En.with_const(v, taux_marge=0.42, source="SOURCE_PRINCIPALE")


@register("c3_line_amount", W + """
SELECT l_orderkey, l_linenumber, CAST(CAST(quantite * prix AS DECIMAL(18,2)) AS DOUBLE) AS montant_calcule
FROM ventes""")
def c3_line_amount(spark, sf_dir):
    v = En.line_amount(ventes(spark, sf_dir), out="montant_calcule")
    return v.select("l_orderkey", "l_linenumber",
                    F.col("montant_calcule").cast("double").alias("montant_calcule"))


@register("c4_with_margin", W + """
SELECT l_orderkey, l_linenumber, CAST(round_even(montant * 0.42, 2) AS DOUBLE) AS marge,
       CAST(round_even(montant * 0.40, 0) AS INTEGER) AS marge_j1,
       CAST(round_even(montant * 0.42, 0) AS INTEGER) AS marge_j4
FROM ventes""")
def c4_with_margin(spark, sf_dir):
    v = ventes(spark, sf_dir)
    v = En.with_margin(v, 0.42, 2)
    v = En.with_margin(v, 0.40, 0, as_int=True, out="marge_j1")
    v = En.with_margin(v, 0.42, 0, as_int=True, out="marge_j4")
    return v.select("l_orderkey", "l_linenumber", F.col("marge").cast("double").alias("marge"),
                    "marge_j1", "marge_j4")


@register("c5_with_attainment", SELLER_YEARS_SQL + f"""
SELECT vendeur, annee, CAST(ca AS DOUBLE) AS ca, CAST(objectif AS DOUBLE) AS objectif,
       {snap('ca * 100 / objectif', 1)} AS atteinte_obj,
       CAST(ca * 100 AS DOUBLE) / CAST(objectif AS DOUBLE) AS atteinte_brute
FROM perf""")
def c5_with_attainment(spark, sf_dir):
    p = En.with_attainment(seller_years(spark, sf_dir))
    p = p.withColumn("atteinte_brute", attainment("ca", "objectif", scale=None))
    return p.select("vendeur", "annee", F.col("ca").cast("double").alias("ca"),
                    F.col("objectif").cast("double").alias("objectif"),
                    "atteinte_obj", "atteinte_brute")


@register("c7_status2", SELLER_YEARS_SQL + f""",
r AS (SELECT vendeur, annee, {snap('ca * 100 / objectif', 1)} AS atteinte_obj FROM perf)
SELECT vendeur, annee, atteinte_obj,
       CASE WHEN atteinte_obj >= 100 THEN '✓ Atteint' ELSE '✗ Non atteint' END AS statut FROM r""")
def c7_status2(spark, sf_dir):
    return seller_performance(seller_years(spark, sf_dir)).select(
        "vendeur", "annee", "atteinte_obj", "statut")


@register("g10_overall_attainment", SELLER_YEARS_SQL + f"""
SELECT annee, CAST(sum(ca) AS DOUBLE) AS ca_total, CAST(sum(objectif) AS DOUBLE) AS objectif_total,
       {snap('sum(ca) * 100 / sum(objectif)', 1)} AS atteinte_pct
FROM perf GROUP BY annee""")
def g10_overall_attainment(spark, sf_dir):
    return overall_attainment(seller_years(spark, sf_dir), by="annee")


@register("c6_bucket", WB + f"""
SELECT l_orderkey, l_linenumber, {bucket_sql('montant')} AS taille_vente,
       {bucket_sql('montant', ('Small', 'Medium', 'Large'))} AS segment,
       {bucket_sql('montant', na='nan')} AS taille_txt
FROM ventes_brutes""")
def c6_bucket(spark, sf_dir):
    b = ventes_brutes(spark, sf_dir)
    b = En.with_size_class(b, EDGES)
    b = En.with_segment(b, EDGES)
    b = En.with_size_class(b, EDGES, out="taille_txt", na_label="nan")
    return b.select("l_orderkey", "l_linenumber", "taille_vente", "segment", "taille_txt")


@register("c8_statuses", W + f""",
d AS (SELECT date, sum(montant) AS ca FROM ventes GROUP BY date)
SELECT date, CAST(ca AS DOUBLE) AS ca_total,
  CASE WHEN ca >= {OBJECTIF} THEN 'excellent' WHEN ca >= {OBJECTIF} * 0.8 THEN 'bon' ELSE 'faible' END
    AS statut_cible,
  CASE WHEN ca > {FIXED_LIMITS[0]} THEN 'excellent' WHEN ca > {FIXED_LIMITS[1]} THEN 'bon'
       ELSE 'faible' END AS statut_fixe,
  CASE WHEN ca * 100 / {OBJECTIF} >= 100 THEN '✓ Atteint'
       WHEN ca * 100 / {OBJECTIF} >= 80 THEN '⚠ Proche' ELSE '✗ En dessous' END AS statut_region
FROM d""")
def c8_statuses(spark, sf_dir):
    d = ventes(spark, sf_dir).groupBy("date").agg(F.sum("montant").alias("ca"))
    obj = F.lit(OBJECTIF).cast(MONEY)
    return d.select("date", F.col("ca").cast("double").alias("ca_total"),
                    L.status_vs_target("ca", obj).alias("statut_cible"),
                    L.status_fixed("ca", limits=FIXED_LIMITS).alias("statut_fixe"),
                    L.status_region(F.col("ca") * 100 / obj).alias("statut_region"))


@register("c9_lookup", """
SELECT l.l_orderkey, l.l_linenumber, p.p_name AS produit, p.p_type AS categorie,
       CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS prix, p.p_partkey IS NULL AS manquant
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""")
def c9_lookup(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber",
                                                 F.col("l_partkey").alias("p_partkey"))
    j = En.lookup(li, products(spark, sf_dir).withColumn("_hit", F.lit(True)), "p_partkey")
    return j.select("l_orderkey", "l_linenumber", "produit", "categorie",
                    F.col("prix").cast("double").alias("prix"),
                    F.col("_hit").isNull().alias("manquant"))


@register("c10_lookup_mod", """
SELECT event_id, (['V1','V2','V3','V4','V5'])[(user_id % 5) + 1] AS vendeur
FROM events""")
def c10_lookup_mod(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id")
    return En.lookup_mod(e, "user_id", ["V1", "V2", "V3", "V4", "V5"],
                         "vendeur").drop("user_id")


@register("c11_cast", W + """
SELECT l_orderkey, l_linenumber, CAST(quantite AS VARCHAR) AS quantite_txt,
       CAST(montant AS DOUBLE) AS montant_reel, CAST(trunc(montant) AS BIGINT) AS montant_entier
FROM ventes""")
def c11_cast(spark, sf_dir):
    v = ventes(spark, sf_dir)
    return v.select("l_orderkey", "l_linenumber",
                    F.col("quantite").cast("string").alias("quantite_txt"),
                    F.col("montant").cast("double").alias("montant_reel"),
                    F.col("montant").cast("bigint").alias("montant_entier"))


@register("c13_head", W + """
SELECT date, l_orderkey, l_linenumber, produit, vendeur FROM ventes
ORDER BY date, l_orderkey, l_linenumber, montant LIMIT 5""")
def c13_head(spark, sf_dir):
    """First rows preview: a top-5 (the limit is the feature), in a total
    order (the line key alone is not unique in the driver data)."""
    return ventes(spark, sf_dir).orderBy(*KEYS, "montant").limit(5) \
        .select(*KEYS, "produit", "vendeur")


@register("d1_for_day", W + """
SELECT date, l_orderkey, l_linenumber, CAST(montant AS DOUBLE) AS montant
FROM ventes WHERE date = (SELECT max(date) FROM ventes)""")
def d1_for_day(spark, sf_dir):
    """The latest day of a date-partitioned table: the scan lists and reads
    that day's directory only."""
    from salesflow.registry.q_sources import load_ventes_table
    from salesflow.sources import for_day, scan
    name = load_ventes_table(spark, sf_dir)
    last = lines(spark, sf_dir).agg(F.max("date")).first()[0]
    return for_day(scan(spark, name), last).select(*KEYS, F.col("montant").cast("double").alias("montant"))


@register("d4_threshold_alert", W + f"""
SELECT date, CAST(sum(montant) AS DOUBLE) AS ca_total,
       CASE WHEN sum(montant) < {SEUIL} THEN 'ALERTE' ELSE 'RAS' END AS alerte
FROM ventes GROUP BY date""")
def d4_threshold_alert(spark, sf_dir):
    return R.threshold_alert(ventes(spark, sf_dir), SEUIL)


@register("d5_classify_day", W + f"""
SELECT date, CAST(sum(montant) AS DOUBLE) AS ca_total,
       CASE WHEN sum(montant) >= {ROUTE_LIMITS[0]} THEN 'traitement_gros_volume'
            WHEN sum(montant) >= {ROUTE_LIMITS[1]} THEN 'traitement_volume_moyen'
            ELSE 'traitement_faible_volume' END AS traitement
FROM ventes GROUP BY date""")
def d5_classify_day(spark, sf_dir):
    return R.classify_day(ventes(spark, sf_dir), ROUTE_LIMITS)


@register("d6_choose_strategy", W + f"""
SELECT date, CAST(sum(montant) AS DOUBLE) AS ca_brut,
       CASE WHEN sum(montant) >= {OBJECTIF} THEN 'traitement_standard'
            ELSE 'traitement_volume_faible' END AS strategie
FROM ventes GROUP BY date""")
def d6_choose_strategy(spark, sf_dir):
    return R.choose_strategy(ventes(spark, sf_dir), OBJECTIF)


@register("c5_ratio_large_groups", W + f""",
g AS (SELECT l_linestatus, sum(montant) AS ca, CAST(count(*) AS DECIMAL(18,2)) AS n FROM ventes GROUP BY 1),
t AS (SELECT *, CAST(n * 10 + n * 0.5 AS DECIMAL(30,2)) AS tie,
             CAST(n * 10 + n * 0.5 - 0.01 AS DECIMAL(30,2)) AS under,
             CAST(n * 10 + n * 0.5 + 0.01 AS DECIMAL(30,2)) AS over FROM g)
SELECT l_linestatus, {snap('ca / n', 2)} AS moyenne, {snap('tie / n', 0)} AS pair,
       {snap('tie / n', 0, even=False)} AS haut, {snap('under / n', 0, even=False)} AS sous,
       {snap('over / n', 0)} AS sur FROM t""")
def c5_ratio_large_groups(spark, sf_dir):
    """Ratios over groups of many rows, at a tie and one cent beside it:
    rounded once, from the exact quotient."""
    from decimal import Decimal
    from salesflow.functions.numeric import ratio
    n = F.count(F.lit(1)).cast("decimal(18,2)")
    g = ventes(spark, sf_dir).groupBy("l_linestatus").agg(F.sum("montant").alias("ca"), n.alias("n"))
    tie = F.col("n") * F.lit(Decimal("10.5"))
    cent = F.lit(Decimal("0.01"))
    return g.select("l_linestatus", ratio("ca", "n", 2).alias("moyenne"), ratio(tie, "n", 0).alias("pair"),
                    ratio(tie, "n", 0, half_even=False).alias("haut"),
                    ratio(tie - cent, "n", 0, half_even=False).alias("sous"),
                    ratio(tie + cent, "n", 0).alias("sur"))
