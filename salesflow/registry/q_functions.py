"""Scalar functions, applied to whole driver tables."""

from pyspark.sql import functions as F

from salesflow.functions import dates as D
from salesflow.functions import text as T
from salesflow.registry import register
from salesflow.registry._sql import WB, W, title_sql
from salesflow.sources.config import parse_config
from salesflow.views import table, ventes, ventes_brutes


@register("k1_title_case", f"""
SELECT p_partkey, {title_sql('p_name')} AS produit_titre, {title_sql('p_type')} AS categorie_titre
FROM part""")
def k1_title_case(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", T.title_case("p_name").alias("produit_titre"),
                    T.title_case("p_type").alias("categorie_titre"))


@register("k2_file_key", """
SELECT p_partkey, replace(lower(substr(p_name, 1, 3)), 'î', 'i') AS code,
       replace(lower(p_name), ' ', '_') AS slug FROM part""")
def k2_file_key(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", T.code_key("p_name").alias("code"), T.slug("p_name").alias("slug"))


@register("k3_prefix_suffix", """
SELECT s_suppkey, starts_with(s_name, 'Supplier#') AS prefixe_ok,
       ends_with(s_name, '0') AS finit_par_0 FROM supplier""")
def k3_prefix_suffix(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return s.select("s_suppkey", T.starts_with("s_name", "Supplier#").alias("prefixe_ok"),
                    T.ends_with("s_name", "0").alias("finit_par_0"))


@register("k4_date_keys", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date, strftime(o_orderdate, '%Y%m%d') AS ds_nodash,
       strftime(o_orderdate, '%Y-%m') AS mois, strftime(o_orderdate + INTERVAL 7 DAY, '%Y-%m-%d') AS date_plus_7
FROM orders""")
def k4_date_keys(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", D.day_key("o_orderdate").alias("date"))
    return o.select("o_orderkey", "date", D.nodash_key("date").alias("ds_nodash"),
                    D.month_key("date").alias("mois"), D.add_days("date", 7).alias("date_plus_7"))


@register("k7_rounding", W + """
SELECT l_orderkey, l_linenumber,
       CAST(round(montant * 0.125, 2) AS DOUBLE) AS arrondi_sql,
       CAST(round_even(montant * 0.125, 2) AS DOUBLE) AS arrondi_pandas
FROM ventes""")
def k7_rounding(spark, sf_dir):
    """K7/K8: half away from zero (SQL) vs half to even (pandas) on exact
    decimal ties."""
    from decimal import Decimal
    v = ventes(spark, sf_dir)
    x = F.col("montant") * F.lit(Decimal("0.125"))
    return v.select("l_orderkey", "l_linenumber",
                    F.round(x, 2).cast("double").alias("arrondi_sql"),
                    F.bround(x, 2).cast("double").alias("arrondi_pandas"))


@register("k9_concat", W + """
SELECT l_orderkey, l_linenumber, vendeur || ' - ' || region AS libelle FROM ventes""")
def k9_concat(spark, sf_dir):
    v = ventes(spark, sf_dir)
    return v.select("l_orderkey", "l_linenumber",
                    F.concat("vendeur", F.lit(" - "), "region").alias("libelle"))


@register("k10_format", W + """,
d AS (SELECT date, sum(montant) AS ca, list(DISTINCT categorie ORDER BY categorie) AS cats
      FROM ventes GROUP BY date)
SELECT date, 'CA : ' || printf('%.2f', CAST(ca AS DOUBLE)) || '€' AS ca_texte,
       array_to_string(cats, ' | ') AS categories FROM d""")
def k10_format(spark, sf_dir):
    v = ventes(spark, sf_dir)
    d = v.groupBy("date").agg(F.sum("montant").alias("ca"),
                              F.array_sort(F.collect_set("categorie")).alias("cats"))
    return d.select("date", F.format_string("CA : %.2f€", F.col("ca").cast("double")).alias("ca_texte"),
                    F.array_join("cats", " | ").alias("categories"))


@register("k11_default", WB + """
SELECT l_orderkey, l_linenumber, coalesce(remise, 0.0) AS remise FROM ventes_brutes""")
def k11_default(spark, sf_dir):
    b = ventes_brutes(spark, sf_dir)
    return b.select("l_orderkey", "l_linenumber",
                    F.coalesce("remise", F.lit(0.0)).alias("remise"))


@register("k12_from_json", """
SELECT event_id, coalesce(CAST(json_extract(props, '$.k') AS INTEGER), 0) AS k FROM events""")
def k12_from_json(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", parse_config("props", "k INT", {"k": 0})["k"].alias("k"))


@register("k13_modulo", """
SELECT event_id, CAST(((user_id % 5) + 5) % 5 AS BIGINT) AS reste FROM events""")
def k13_modulo(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.pmod("user_id", F.lit(5)).cast("bigint").alias("reste"))


@register("k14_elapsed", """
SELECT event_id, date_diff('second', date_trunc('day', ts), ts) AS secondes_depuis_minuit,
       true AS horodate FROM events""")
def k14_elapsed(spark, sf_dir):
    """Elapsed seconds (timestampdiff) and a load stamp; the clock value
    itself is not comparable, so only its presence is returned."""
    e = table(spark, sf_dir, "events").withColumn("charge_le", F.current_timestamp())
    return e.select("event_id",
                    F.expr("timestampdiff(SECOND, date_trunc('DAY', ts), ts)").alias(
                        "secondes_depuis_minuit"),
                    F.col("charge_le").isNotNull().alias("horodate"))


@register("k15_null_nan", WB + """
SELECT l_orderkey, l_linenumber, remise IS NULL AS est_null,
       coalesce(isnan(remise), false) AS est_nan FROM ventes_brutes""")
def k15_null_nan(spark, sf_dir):
    b = ventes_brutes(spark, sf_dir)
    return b.select("l_orderkey", "l_linenumber", F.col("remise").isNull().alias("est_null"),
                    F.coalesce(F.isnan("remise"), F.lit(False)).alias("est_nan"))


@register("k16_sql_params", W + """
SELECT date, count(*) AS nb_ventes FROM ventes WHERE montant >= 50000 GROUP BY date""")
def k16_sql_params(spark, sf_dir):
    """Run-time parameters bound into SQL text (named parameters, no
    string interpolation of values)."""
    return spark.sql("SELECT date, count(*) AS nb_ventes FROM {v} WHERE montant >= :seuil "
                     "GROUP BY date", args={"seuil": 50000}, v=ventes(spark, sf_dir))
