"""E8 as a ledger, E4/G15 in chunks."""

from pyspark.sql import functions as F

from salesflow.operators import ledger as L
from salesflow.operators import quality as Q
from salesflow.registry import register
from salesflow.registry._sql import MIN_LIGNES, W
from salesflow.session import unique_table
from salesflow.views import vendeurs_valides, ventes, ventes_brutes

CHUNK = 10
_BAD = "l_returnflag = 'R' AND l_linenumber = 7 AND l_discount >= 0.05"
_COLS = ("date", "vendeur", "montant", "l_orderkey", "l_linenumber")


def _ledger(spark, sf_dir):
    """Refunds are sent as negative amounts; then the first half of each year is
    sent again without the mistake."""
    v = ventes(spark, sf_dir)
    rows, register_ = unique_table("livraisons"), unique_table("registre")
    sent = v.withColumn("montant", F.when(F.expr(_BAD), -F.col("montant")).otherwise(F.col("montant"))).select(*_COLS)
    L.load_day_rows(spark, sent, L.standard_rules(sent), rows, register_, 1, MIN_LIGNES)
    again = v.where(F.substring("date", 6, 2) <= "06").select(*_COLS)
    L.load_day_rows(spark, again, L.standard_rules(again), rows, register_, 2, MIN_LIGNES)
    return rows, register_


_DAYS = W + f""",
d AS (SELECT date, count(*) AS nb, count(*) FILTER (WHERE {_BAD}) AS nb_bad, substr(date, 6, 2) <= '06' AS again
      FROM ventes GROUP BY date),
j AS (SELECT date, nb, CASE WHEN again THEN 0 ELSE nb_bad END AS nb_fautives,
             (nb_bad > 0 AND NOT again) OR nb < {MIN_LIGNES} AS held, nb_bad > 0 OR nb < {MIN_LIGNES} AS held_first,
             nb_bad > 0 AND NOT again AS bad FROM d)"""


@register("e8_ledger", _DAYS + f"""
SELECT date, CASE WHEN held THEN 'OUVERT' WHEN held_first THEN 'CLOS' ELSE 'ADMIS' END AS etat,
       concat_ws('|', CASE WHEN bad THEN 'MONTANT' END, CASE WHEN nb < {MIN_LIGNES} THEN 'VOLUME' END) AS raisons,
       nb AS nb_lignes, nb_fautives FROM j""")
def e8_ledger(spark, sf_dir):
    _, register_ = _ledger(spark, sf_dir)
    return L.current_verdicts(spark, register_).select(
        "date", "etat", F.array_join("raisons", "|").alias("raisons"), "nb_lignes", "nb_fautives")


@register("e8_ledger_layers", _DAYS + f"""
SELECT v.date, l_orderkey, l_linenumber, held AS retenue,
       CAST(CASE WHEN {_BAD} AND substr(v.date, 6, 2) > '06' THEN -montant ELSE montant END AS DOUBLE) AS montant,
       CASE WHEN {_BAD} AND substr(v.date, 6, 2) > '06' THEN 'MONTANT' ELSE '' END AS raisons
FROM ventes v JOIN j USING (date)""")
def e8_ledger_layers(spark, sf_dir):
    admitted, held = L.layers(spark, *_ledger(spark, sf_dir))
    both = admitted.withColumn("retenue", F.lit(False)).unionByName(held.withColumn("retenue", F.lit(True)))
    return both.select("date", "l_orderkey", "l_linenumber", "retenue", F.col("montant").cast("double").alias("montant"),
                       F.array_join("raisons", "|").alias("raisons"))


def _chunks_sql(source: str, where: str, col: str) -> str:
    return W + f""",
u AS (SELECT DISTINCT date, {col} AS v FROM {source} WHERE {where}),
r AS (SELECT date, v, row_number() OVER (PARTITION BY date ORDER BY v) - 1 AS rn, count(*) OVER (PARTITION BY date) AS n FROM u)
SELECT date, CAST(rn // {CHUNK} AS BIGINT) AS morceau, count(*) AS nb, max(n) AS nb_total,
       string_agg(v, '|' ORDER BY v) AS valeurs FROM r GROUP BY 1, 2"""


@register("e4_unknown_chunks", _chunks_sql(
    "ventes", "vendeur NOT IN (SELECT s_name FROM supplier WHERE s_acctbal >= 0)", "vendeur"))
def e4_unknown_chunks(spark, sf_dir):
    """Unknown sellers of each day, at most 10 a row, none cut."""
    bad = Q.unknown_rows(ventes_brutes(spark, sf_dir), vendeurs_valides(spark, sf_dir))
    return Q.value_chunks(bad, "vendeur", CHUNK).withColumn("valeurs", F.array_join("valeurs", "|"))


@register("g15_value_chunks", _chunks_sql("ventes", "produit IS NOT NULL", "produit"))
def g15_value_chunks(spark, sf_dir):
    """The products of each day, at most 10 a row."""
    return Q.value_chunks(ventes(spark, sf_dir), "produit", CHUNK).withColumn("valeurs", F.array_join("valeurs", "|"))
