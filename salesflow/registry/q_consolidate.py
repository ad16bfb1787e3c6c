"""Multi-source consolidation."""

from pyspark.sql import functions as F

from salesflow.functions.numeric import MONEY
from salesflow.operators import consolidate as C
from salesflow.registry import register
from salesflow.registry._sql import W, WV
from salesflow.session import scratch_path
from salesflow.sources.fallback import with_fallback
from salesflow.views import ventes, vendeurs_valides

LINE = ("l_orderkey", "l_linenumber")


def landed(spark, sf_dir, *cols):
    """The sales, joined once and written with the columns that the branches
    of a query need: each branch then scans a narrow table."""
    path = scratch_path(spark, "ventes")
    ventes(spark, sf_dir).select(*cols).write.parquet(path)
    return spark.read.parquet(path)


API_COLS = ("date", "vendeur", "produit", "region", "montant", *LINE, "l_linestatus")


def api_primary(v):
    """The primary API feed: it only delivers finished lines."""
    return v.where(F.col("l_linestatus") == "F").select(
        "date", "vendeur", "produit", "montant", *LINE, F.lit("API_REST").alias("source"))


def api_backup(v):
    return v.select("date", "vendeur", "produit", "montant", *LINE)


def api_rows(spark, sf_dir, v=None):
    """Primary feed, backup rows for the days it lacks."""
    v = landed(spark, sf_dir, *API_COLS) if v is None else v
    return with_fallback(api_primary(v), api_backup(v))


def region_files(spark, sf_dir, v=None):
    """Region file rows: one per (date, region)."""
    v = ventes(spark, sf_dir) if v is None else v
    return v.groupBy("date", "region").agg(
        F.sum("montant").alias("ca_region"), F.count(F.lit(1)).alias("nb_ventes")) \
        .withColumn("source", F.lit("FICHIER_LOCAL"))


API_SQL = W + """,
prim AS (SELECT date, vendeur, produit, montant, l_orderkey, l_linenumber, 'API_REST' AS source
         FROM ventes WHERE l_linestatus = 'F'),
api AS (SELECT * FROM prim UNION ALL
        SELECT date, vendeur, produit, montant, l_orderkey, l_linenumber, 'FALLBACK' AS source
        FROM ventes WHERE date NOT IN (SELECT date FROM prim)),
files AS (SELECT date, region, sum(montant) AS ca_region, count(*) AS nb_ventes,
                 'FICHIER_LOCAL' AS source FROM ventes GROUP BY date, region),
consolide AS (
  SELECT date, 'vendeur' AS dimension, vendeur AS valeur, sum(montant) AS ca, min(source) AS source
  FROM api GROUP BY date, vendeur
  UNION ALL
  SELECT date, 'region', region, CAST(ca_region AS DECIMAL(18,2)), source FROM files)"""


@register("a7_with_fallback", API_SQL + """
SELECT date, vendeur, produit, CAST(montant AS DOUBLE) AS montant, l_orderkey, l_linenumber, source
FROM api""")
def a7_with_fallback(spark, sf_dir):
    return api_rows(spark, sf_dir).withColumn("montant", F.col("montant").cast("double"))


@register("j1_concat", API_SQL + """
SELECT date, vendeur, produit, CAST(montant AS DOUBLE) AS montant, NULL::VARCHAR AS region,
       NULL::DOUBLE AS ca_region, NULL::BIGINT AS nb_ventes, source FROM prim
UNION ALL
SELECT date, NULL, NULL, NULL, region, CAST(ca_region AS DOUBLE), nb_ventes, source FROM files""")
def j1_concat(spark, sf_dir):
    v = landed(spark, sf_dir, *API_COLS)
    a = api_primary(v).drop(*LINE).withColumn("montant", F.col("montant").cast("double"))
    f = region_files(spark, sf_dir, v).withColumn("ca_region", F.col("ca_region").cast("double"))
    return C.concat([a, f])


@register("j2_concat_skip_empty", API_SQL + """
SELECT date, region, CAST(ca_region AS DOUBLE) AS ca_region, nb_ventes, source FROM files""")
def j2_concat_skip_empty(spark, sf_dir):
    """Absent sources (None) and empty ones add nothing to the union."""
    f = region_files(spark, sf_dir).withColumn("ca_region", F.col("ca_region").cast("double"))
    empty = f.where(F.lit(False))
    return C.concat([None, empty, f, None])


@register("j3_consolidate", API_SQL + """
SELECT date, dimension, valeur, CAST(ca AS DOUBLE) AS ca, source FROM consolide""")
def j3_consolidate(spark, sf_dir):
    v = landed(spark, sf_dir, *API_COLS)
    out = C.consolidate(api_rows(spark, sf_dir, v), region_files(spark, sf_dir, v))
    return out.withColumn("ca", F.col("ca").cast("double"))


@register("d2_consolidated_total", API_SQL + """
SELECT date, CAST(sum(ca) AS DOUBLE) AS ca_total,
       CASE WHEN coalesce(sum(ca), 0) = 0 THEN 'N/A' ELSE printf('%.0f', CAST(sum(ca) AS DOUBLE)) END
         AS ca_texte
FROM consolide WHERE dimension = 'vendeur' GROUP BY date""")
def d2_consolidated_total(spark, sf_dir):
    v = landed(spark, sf_dir, *API_COLS)
    return C.consolidated_total(C.consolidate(api_rows(spark, sf_dir, v), region_files(spark, sf_dir, v)))


@register("d2_day_without_sellers", API_SQL + """
SELECT date, CAST(CASE WHEN l THEN NULL ELSE t END AS DOUBLE) AS ca_total,
       CASE WHEN l OR coalesce(t, 0) = 0 THEN 'N/A' ELSE printf('%.0f', CAST(round_even(t, 0) AS DOUBLE)) END AS ca_texte
FROM (SELECT date, date = (SELECT max(date) FROM ventes) AS l,
             sum(ca) FILTER (WHERE dimension = 'vendeur') AS t FROM consolide GROUP BY date)""")
def d2_day_without_sellers(spark, sf_dir):
    """The last day has region files only: its total is not available."""
    v = landed(spark, sf_dir, *API_COLS)
    last = v.agg(F.max("date")).scalar()
    api = api_rows(spark, sf_dir, v).where(F.col("date") != last)
    return C.consolidated_total(C.consolidate(api, region_files(spark, sf_dir, v)))


@register("j4_set_difference", WV + """
SELECT DISTINCT vendeur FROM ventes WHERE vendeur NOT IN (SELECT vendeur FROM vendeurs_valides)""")
def j4_set_difference(spark, sf_dir):
    return C.set_difference(ventes(spark, sf_dir), vendeurs_valides(spark, sf_dir), ["vendeur"])


@register("j5_dedupe", W + """
SELECT l_orderkey, l_linenumber, date, CAST(montant AS DOUBLE) AS montant FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, montant DESC) AS rn
  FROM ventes) WHERE rn = 1""")
def j5_dedupe(spark, sf_dir):
    """Latest version per key wins: per order, the last line (ties on
    the line number broken by amount)."""
    v = ventes(spark, sf_dir).select(*LINE, "date", F.col("montant").cast(MONEY))
    return C.dedupe(v, ["l_orderkey"], ["l_linenumber", "montant"]).withColumn(
        "montant", F.col("montant").cast("double"))


@register("g4_seller_totals", API_SQL + """
SELECT date, vendeur, CAST(sum(montant) AS DOUBLE) AS ca, min(source) AS source
FROM api GROUP BY date, vendeur""")
def g4_seller_totals(spark, sf_dir):
    """Seller totals with the SQL's bare ``source`` column made
    deterministic (``min``): the seller half of the consolidated view."""
    s = C.consolidate(api_rows(spark, sf_dir), None)
    return s.select("date", F.col("valeur").alias("vendeur"), F.col("ca").cast("double").alias("ca"),
                    "source")
