"""Quality checks on the raw sales view."""

from pyspark.sql import functions as F

from salesflow.operators import kpis as K
from salesflow.operators import quality as Q
from salesflow.registry import register
from salesflow.registry.q_consolidate import landed
from salesflow.registry._sql import MIN_LIGNES, W, WB, WBV
from salesflow.views import ventes, ventes_brutes, vendeurs_valides

_NULLS = ("(date IS NULL)::INT + (produit IS NULL)::INT + (categorie IS NULL)::INT + "
          "(vendeur IS NULL)::INT + (region IS NULL)::INT + (quantite IS NULL)::INT + "
          "(montant IS NULL)::INT + (remise IS NULL OR isnan(remise))::INT + "
          "(l_orderkey IS NULL)::INT + (l_linenumber IS NULL)::INT")

_UNKNOWN_SQL = """
unk AS (SELECT date, count(*) AS nb_inconnus,
               string_agg('''' || coalesce(vendeur, 'None') || '''', ', '
                          ORDER BY coalesce(vendeur, 'None')) AS inconnus_txt,
               string_agg(coalesce(vendeur, 'None'), '|' ORDER BY coalesce(vendeur, 'None')) AS inconnus
        FROM (SELECT DISTINCT date, vendeur FROM {src}) x
        WHERE vendeur IS NULL OR vendeur NOT IN (SELECT vendeur FROM vendeurs_valides)
        GROUP BY date)"""


@register("e1_null_cells", WB + f"""
SELECT date, CAST(sum({_NULLS}) AS BIGINT) AS nb_nulls FROM ventes_brutes GROUP BY date""")
def e1_null_cells(spark, sf_dir):
    return Q.null_cells(ventes_brutes(spark, sf_dir))


@register("e2_nonpositive", WB + """
SELECT date, count(*) FILTER (WHERE montant <= 0) AS nb_non_positifs
FROM ventes_brutes GROUP BY date""")
def e2_nonpositive(spark, sf_dir):
    return Q.nonpositive(ventes_brutes(spark, sf_dir))


@register("e3_min_rows", WB + f"""
SELECT date, count(*) AS nb_lignes, count(*) >= {MIN_LIGNES} AS volume_ok
FROM ventes_brutes GROUP BY date""")
def e3_min_rows(spark, sf_dir):
    return Q.min_rows(ventes_brutes(spark, sf_dir), MIN_LIGNES)


@register("e4_unknown_values", WBV + "," + _UNKNOWN_SQL.format(src="ventes_brutes") + """
SELECT date, nb_inconnus, inconnus FROM unk""")
def e4_unknown_values(spark, sf_dir):
    u = Q.unknown_values(ventes_brutes(spark, sf_dir), vendeurs_valides(spark, sf_dir))
    return u.select("date", "nb_inconnus", F.array_join("inconnus", "|").alias("inconnus"))


@register("e5_is_empty", W + """,
cal AS (SELECT strftime(CAST(d AS DATE), '%Y-%m-%d') AS date FROM (
        SELECT unnest(generate_series(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP),
                                      INTERVAL 1 DAY)) AS d FROM ventes)),
n AS (SELECT date, count(*) AS c FROM ventes GROUP BY date)
SELECT cal.date, coalesce(c, 0) AS nb_lignes, c IS NULL AS vide FROM cal LEFT JOIN n USING (date)""")
def e5_is_empty(spark, sf_dir):
    return Q.is_empty(ventes(spark, sf_dir))


_E6_SQL = WBV + "," + _UNKNOWN_SQL.format(src="ventes_brutes") + f""",
s AS (SELECT date, count(*) AS nb_lignes, CAST(sum({_NULLS}) AS BIGINT) AS nn,
             count(*) FILTER (WHERE montant <= 0) AS neg FROM ventes_brutes GROUP BY date),
r AS (SELECT s.date, s.nb_lignes, concat_ws(' | ',
        CASE WHEN nn > 0 THEN 'Valeurs nulles : ' || nn END,
        CASE WHEN s.nb_lignes = 0 THEN 'DataFrame vide' END,
        CASE WHEN neg > 0 THEN 'Montants négatifs : ' || neg END,
        CASE WHEN coalesce(nb_inconnus, 0) > 0 THEN 'Vendeurs inconnus : {{' || inconnus_txt || '}}' END
      ) AS erreurs
      FROM s LEFT JOIN unk USING (date))
SELECT date, erreurs = '' AS valid, erreurs, nb_lignes FROM r"""


@register("e6_validate_testable", _E6_SQL)
def e6_validate_testable(spark, sf_dir):
    r = Q.validate_testable(ventes_brutes(spark, sf_dir), vendeurs_valides(spark, sf_dir))
    return r.select("date", "valid", F.array_join("erreurs", " | ").alias("erreurs"), "nb_lignes")


@register("e6b_validate_final", WB + f""",
s AS (SELECT date, count(*) AS nb, CAST(sum({_NULLS}) AS BIGINT) AS nn,
             count(*) FILTER (WHERE montant <= 0) AS neg FROM ventes_brutes GROUP BY date),
r AS (SELECT date, nb, concat_ws(' | ',
        CASE WHEN nb < {MIN_LIGNES} THEN 'Volume insuffisant : ' || nb || ' < {MIN_LIGNES}' END,
        CASE WHEN nn > 0 THEN 'Valeurs nulles : ' || nn END,
        CASE WHEN neg > 0 THEN 'Montants négatifs ou nuls' END) AS erreurs FROM s)
SELECT date, erreurs = '' AS valid, erreurs, nb FROM r""")
def e6b_validate_final(spark, sf_dir):
    r = Q.validate_final(ventes_brutes(spark, sf_dir), MIN_LIGNES)
    return r.select("date", "valid", F.array_join("erreurs", " | ").alias("erreurs"), "nb")


@register("e7_health_checks", WBV + f""",
f AS (SELECT b.*, v.vendeur IS NOT NULL AS known FROM ventes_brutes b
      LEFT JOIN (SELECT DISTINCT vendeur FROM vendeurs_valides) v ON b.vendeur = v.vendeur),
s AS (SELECT date, sum({_NULLS.replace('vendeur IS', 'b_vendeur IS')}) = 0 AS pas_de_nulls,
             bool_and(coalesce(montant > 0, false)) AS montants_positifs,
             count(*) >= {MIN_LIGNES} AS volume_ok, bool_and(known) AS vendeurs_valides
      FROM (SELECT *, vendeur AS b_vendeur FROM f) GROUP BY date)
SELECT date, pas_de_nulls, montants_positifs, volume_ok, vendeurs_valides,
       concat_ws(',', CASE WHEN NOT pas_de_nulls THEN 'pas_de_nulls' END,
                      CASE WHEN NOT montants_positifs THEN 'montants_positifs' END,
                      CASE WHEN NOT volume_ok THEN 'volume_ok' END,
                      CASE WHEN NOT vendeurs_valides THEN 'vendeurs_valides' END) AS checks_echoues
FROM s""")
def e7_health_checks(spark, sf_dir):
    h = Q.health_checks(ventes_brutes(spark, sf_dir), vendeurs_valides(spark, sf_dir), MIN_LIGNES)
    return h.select("date", *[F.col("checks")[n].alias(n) for n in Q.CHECK_NAMES],
                    F.array_join("checks_echoues", ",").alias("checks_echoues"))


@register("e8_quarantine", W + f""",
ok AS (SELECT date FROM ventes GROUP BY date HAVING count(*) >= {MIN_LIGNES})
SELECT date, l_orderkey, l_linenumber, CAST(montant AS DOUBLE) AS montant
FROM ventes WHERE date IN (SELECT date FROM ok)""")
def e8_quarantine(spark, sf_dir):
    v = landed(spark, sf_dir, "date", "l_orderkey", "l_linenumber", "montant")
    accepted, _ = Q.quarantine(v, Q.validate_final(v, MIN_LIGNES))
    return accepted.select("date", "l_orderkey", "l_linenumber",
                           F.col("montant").cast("double").alias("montant"))


@register("e10_reconcile", WB + f""",
clean AS (SELECT * FROM ventes_brutes WHERE montant > 0),
k AS (SELECT date FROM clean GROUP BY date),
c AS (SELECT date, count(*) AS n FROM clean GROUP BY date),
r AS (SELECT date, count(*) AS n FROM ventes_brutes GROUP BY date)
SELECT r.date, r.n AS nb_raw, coalesce(c.n, 0) AS nb_clean,
       CAST(k.date IS NOT NULL AS BIGINT) AS nb_kpis,
       r.n > 0 AND coalesce(c.n, 0) > 0 AND k.date IS NOT NULL AS complet
FROM r LEFT JOIN c USING (date) LEFT JOIN k USING (date)""")
def e10_reconcile(spark, sf_dir):
    raw = ventes_brutes(spark, sf_dir)
    clean = raw.where(F.col("montant") > 0)
    kp = K.day_totals(clean)
    return Q.reconcile({"raw": raw, "clean": clean, "kpis": kp})


@register("e11_load_summary", WB + """
SELECT date, count(*) AS nb_lignes, CAST(sum(montant) AS DOUBLE) AS ca_brut, count(*) > 0 AS is_valid
FROM ventes_brutes GROUP BY date""")
def e11_load_summary(spark, sf_dir):
    return Q.load_summary(ventes_brutes(spark, sf_dir))


@register("d3_predicates", WBV + """
SELECT date, count(*) FILTER (WHERE montant <= 0) AS nb_non_positifs,
       count(*) FILTER (WHERE montant > 0) AS nb_positifs,
       count(*) FILTER (WHERE remise IS NULL) AS nb_remise_nulle,
       count(*) FILTER (WHERE vendeur IN (SELECT vendeur FROM vendeurs_valides)) AS nb_vendeurs_connus
FROM ventes_brutes GROUP BY date""")
def d3_predicates(spark, sf_dir):
    b = ventes_brutes(spark, sf_dir)
    dom = vendeurs_valides(spark, sf_dir).distinct().withColumn("_known", F.lit(True))
    j = b.join(dom, "vendeur", "left")
    return j.groupBy("date").agg(
        F.count_if(F.col("montant") <= 0).alias("nb_non_positifs"),
        F.count_if(F.col("montant") > 0).alias("nb_positifs"),
        F.count_if(F.col("remise").isNull()).alias("nb_remise_nulle"),
        F.count_if(F.col("_known").isNotNull()).alias("nb_vendeurs_connus"))


@register("g14_any_all", WB + """
SELECT date, bool_or(coalesce(montant <= 0, false)) AS a_un_non_positif,
       bool_and(coalesce(montant > 0, false)) AS tous_positifs,
       bool_or(coalesce(remise IS NULL, false)) AS a_une_remise_nulle
FROM ventes_brutes GROUP BY date""")
def g14_any_all(spark, sf_dir):
    b = ventes_brutes(spark, sf_dir)
    return Q.any_all(b, any_={"a_un_non_positif": F.col("montant") <= 0,
                              "a_une_remise_nulle": F.col("remise").isNull()},
                     all_={"tous_positifs": F.col("montant") > 0})


@register("g15_distinct_values", W + """
SELECT date, count(DISTINCT categorie) AS nb_categorie,
       array_to_string(list_sort(list(DISTINCT categorie)), '|') AS categories
FROM ventes GROUP BY date""")
def g15_distinct_values(spark, sf_dir):
    d = Q.distinct_values(ventes(spark, sf_dir), "categorie")
    return d.select("date", "nb_categorie", F.array_join("categories", "|").alias("categories"))


@register("e6_expected_days", WB + f""",
b AS (SELECT min(date) AS d0 FROM ventes_brutes)
SELECT date, CASE WHEN date = d0 THEN 0 ELSE count(*) END AS nb,
       CASE WHEN date = d0 THEN 'Volume insuffisant : 0 < {MIN_LIGNES}'
            WHEN count(*) < {MIN_LIGNES} THEN 'Volume insuffisant : ' || count(*) || ' < {MIN_LIGNES}' ELSE '' END AS erreurs
FROM ventes_brutes, b GROUP BY date, d0""")
def e6_expected_days(spark, sf_dir):
    """A day that should have rows and has none fails the validation."""
    v = landed(spark, sf_dir, "date", "l_orderkey", "l_linenumber", "montant")
    some = v.where(F.col("date") != v.agg(F.min("date")).scalar())
    r = Q.validate_final(some, MIN_LIGNES, expected=v.select("date"))
    return r.select("date", "nb", F.array_join("erreurs", " | ").alias("erreurs"))
