"""The composite jobs, each returning its last report."""

from pyspark.sql import functions as F

from salesflow.functions.text import code_key
from salesflow.layout import by_day
from salesflow.plans import jobs as J
from salesflow.registry import register
from salesflow.registry._sql import (EDGES, MIN_LIGNES, OBJECTIF, W, WB, bucket_sql, snap, title_sql,
                                     top_sql)
from salesflow.registry.q_consolidate import API_SQL, api_rows, region_files
from salesflow.registry.q_enrich import SELLER_YEARS_SQL, ROUTE_LIMITS, seller_years
from salesflow.registry.q_kpis import _G7_SQL, CONSOLIDATED_LIMITS, g6_sql
from salesflow.registry.q_monitoring import METRICS_SQL, SLA_LIMITS, run_metrics_from_events
from salesflow.registry.q_reports import REGION_TARGETS, REGION_TARGETS_SQL, _REGION_SQL, _targets
from salesflow.registry.q_sources import REGION_SCHEMA, write_region_files
from salesflow.session import scratch_path, unique_table
from salesflow.sinks import write_csv
from salesflow.views import (OBJECTIFS_SQL, VENDEURS_VALIDES_SQL, lines, objectifs_regions, table, ventes,
                             ventes_brutes, vendeurs_valides)

# The state after a replay: the first day was delivered empty the second
# time, the last day with its first lines only.
VC = W + """,
b AS (SELECT min(date) AS d0, max(date) AS d1 FROM ventes),
vc AS (SELECT v.* FROM ventes v, b WHERE date NOT IN (d0, d1) OR (date = d1 AND l_linenumber = 1))"""


def replay(spark, sf_dir, run, rows=ventes, land=False):
    """``run(rows, days)`` on everything, twice on the two corrected days;
    the last result.  ``land``: the rows are joined once and lie by day, for
    jobs that read them more than once in a run."""
    v = rows(spark, sf_dir)
    if land:
        v = by_day(spark, v)
    d0, d1 = lines(spark, sf_dir).agg(F.min("date"), F.max("date")).first()
    corrected = v.where((F.col("date") == d1) & (F.col("l_linenumber") == 1))
    run(v, None)
    run(corrected, [d0, d1])
    return run(corrected, [d0, d1])


CODES = ("afr", "ame", "asi", "eur", "mid", "xyz")


def _money(df, *cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


@register("n1_simple_etl", W + f"""
SELECT date, produit, categorie, quantite, CAST(prix AS DOUBLE) AS prix,
       CAST(montant AS DOUBLE) AS montant, {title_sql('vendeur')} AS vendeur,
       CAST(round_even(montant * 0.40, 0) AS INTEGER) AS marge, {bucket_sql('montant')} AS taille_vente
FROM ventes""")
def n1_simple_etl(spark, sf_dir):
    raw = ventes(spark, sf_dir).select("date", "produit", "categorie", "quantite", "prix",
                                       "montant", "vendeur")
    return _money(J.simple_etl(spark, raw, scratch_path(spark, "n1"), EDGES), "prix", "montant")


def _n2(spark, sf_dir):
    inbox = scratch_path(spark, "n2-in")
    write_csv(seller_years(spark, sf_dir), inbox)
    paths = [scratch_path(spark, f"n2-{x}") for x in ("target", "ckpt", "out")]
    schema = "vendeur string, annee string, ca decimal(18,2), objectif decimal(18,2)"
    return J.seller_performance_report(spark, inbox, schema, *paths)


@register("n2_seller_performance", SELLER_YEARS_SQL + f""",
r AS (SELECT *, {snap('ca * 100 / objectif', 1)} AS atteinte_obj FROM perf)
SELECT vendeur, annee, CAST(ca AS DOUBLE) AS ca, CAST(objectif AS DOUBLE) AS objectif, atteinte_obj,
       CASE WHEN atteinte_obj >= 100 THEN '✓ Atteint' ELSE '✗ Non atteint' END AS statut FROM r""")
def n2_seller_performance(spark, sf_dir):
    return _money(_n2(spark, sf_dir)[0], "ca", "objectif")


@register("n2_overall", SELLER_YEARS_SQL + f"""
SELECT CAST(sum(ca) AS DOUBLE) AS ca_total, CAST(sum(objectif) AS DOUBLE) AS objectif_total,
       {snap('sum(ca) * 100 / sum(objectif)', 1)} AS atteinte_pct FROM perf""")
def n2_overall(spark, sf_dir):
    return _n2(spark, sf_dir)[1]


@register("n3_regional_consolidation", W + """,
f AS (SELECT date, region, sum(montant) AS ca FROM ventes GROUP BY date, region)
SELECT 'ligne' AS couche, date, region, CAST(ca AS DOUBLE) AS ca, 1 AS nb FROM f
UNION ALL SELECT 'total', date, NULL, CAST(sum(ca) AS DOUBLE), count(*) FROM f GROUP BY date""")
def n3_regional_consolidation(spark, sf_dir):
    """The concatenated rows as written, and the day totals."""
    folder = write_region_files(spark, sf_dir, scratch_path(spark, "n3"))
    paths = [f"{folder}/code={c}" for c in CODES]
    rows, tot = J.regional_consolidation(spark, paths, REGION_SCHEMA, scratch_path(spark, "n3-out"))
    return rows.select(F.lit("ligne").alias("couche"), "date", "region",
                       F.col("ca_region").cast("double").alias("ca"), F.lit(1).cast("bigint").alias("nb")).unionByName(
        tot.select(F.lit("total").alias("couche"), "date", F.lit(None).cast("string").alias("region"),
                   F.col("ca_total").alias("ca"), F.col("nb_lignes").alias("nb")))


@register("n4_warehouse_reports", VC + f"""
SELECT 'vendeur' AS rapport, vendeur AS cle, count(*) AS nb_ventes,
       CAST(round(sum(montant)) AS DOUBLE) AS ca_total,
       {snap('sum(montant) / count(montant)', 0, even=False)} AS valeur
FROM vc GROUP BY vendeur
UNION ALL
SELECT 'categorie', categorie, NULL, CAST(round(sum(montant)) AS DOUBLE),
       {snap('sum(montant) * 100 / (SELECT sum(montant) FROM vc)', 1, even=False)}
FROM vc GROUP BY categorie
UNION ALL
SELECT 'verification', d, coalesce(n, 0), NULL, CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END
FROM (SELECT unnest([d0, d1]) AS d FROM b) LEFT JOIN (SELECT date, count(*) AS n FROM vc GROUP BY date) ON d = date""")
def n4_warehouse_reports(spark, sf_dir):
    """Both reports over the table after a replay, and the verification of
    the replayed days, one of which is empty."""
    prefix, null = unique_table("n4"), F.lit(None)

    def run(rows, days):
        want = spark.createDataFrame([(d,) for d in days], "date string") if days else None
        return J.warehouse_reports(spark, rows, scratch_path(spark, "n4"), prefix, days, want)
    check, seller, cat = replay(spark, sf_dir, run)
    return seller.select(F.lit("vendeur").alias("rapport"), F.col("vendeur").alias("cle"), "nb_ventes", "ca_total",
                         F.col("panier_moyen").alias("valeur")).unionByName(
        cat.select(F.lit("categorie").alias("rapport"), F.col("categorie").alias("cle"),
                   null.cast("bigint").alias("nb_ventes"), "ca_total", F.col("part_pct").alias("valeur"))).unionByName(
        check.select(F.lit("verification").alias("rapport"), F.col("date").alias("cle"),
                     F.col("nb_lignes").alias("nb_ventes"), null.cast("double").alias("ca_total"),
                     F.col("ok").cast("int").cast("double").alias("valeur")))


@register("n5_json_ingest", """
SELECT event_id AS id, user_id AS userId, event_type AS title FROM events ORDER BY id LIMIT 5""")
def n5_json_ingest(spark, sf_dir):
    path = scratch_path(spark, "n5")
    table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("userId"),
        F.col("event_type").alias("title"), F.col("props").alias("body")).write.json(path)
    return J.json_ingest(spark, path, "id bigint, userId bigint, title string, body string",
                         ["id", "userId", "title"], scratch_path(spark, "n5-out"))


@register("n6_load_guard", W + """,
b AS (SELECT min(date) AS d0 FROM ventes)
SELECT date, count(*) FILTER (WHERE date <> d0) AS nb_lignes, count(*) FILTER (WHERE date <> d0) > 0 AS ok
FROM ventes, b GROUP BY date""")
def n6_load_guard(spark, sf_dir):
    """Every day was to be loaded; the first was not delivered."""
    v = ventes(spark, sf_dir)
    d0 = lines(spark, sf_dir).agg(F.min("date")).first()[0]
    return J.load_guard(spark, v.where(F.col("date") != d0), expected=lines(spark, sf_dir).select("date"), edges=EDGES)


RV_SCHEMA = "date string, region string, vendeur string, ca decimal(18,2)"


@register("n7_regional_kpis", W + f""",
rv AS (SELECT date, region, vendeur, sum(montant) AS ca FROM ventes GROUP BY date, region, vendeur)
SELECT date, CAST(trunc(sum(ca)) AS BIGINT) AS ca_total, count(*) AS nb_vendeurs,
       CASE WHEN trunc(sum(ca)) > {CONSOLIDATED_LIMITS[0]} THEN 'excellent'
            WHEN trunc(sum(ca)) > {CONSOLIDATED_LIMITS[1]} THEN 'bon' ELSE 'faible' END AS statut
FROM rv GROUP BY date
UNION ALL SELECT '2099-01-01', 0, 0, 'vide'""")
def n7_regional_kpis(spark, sf_dir):
    """One day of the calendar has no extract, and one region none at all."""
    folder = scratch_path(spark, "n7")
    rv = ventes(spark, sf_dir).groupBy("date", "region", "vendeur").agg(F.sum("montant").alias("ca"))
    rv.withColumn("code", code_key("region")).write.partitionBy("code") \
        .option("header", True).csv(folder)
    paths = [f"{folder}/code={c}" for c in CODES]
    days = lines(spark, sf_dir).select("date").union(spark.createDataFrame([("2099-01-01",)], "date string"))
    return J.regional_kpis(spark, paths, RV_SCHEMA, days, limits=CONSOLIDATED_LIMITS)


@register("n7_no_file", W + "SELECT DISTINCT date, 0 AS ca_total, 0 AS nb_vendeurs, 'vide' AS statut FROM ventes")
def n7_no_file(spark, sf_dir):
    """No extract was delivered: every day of the calendar is empty."""
    paths = [f"{scratch_path(spark, 'n7-none')}/code={c}" for c in CODES]
    return J.regional_kpis(spark, paths, RV_SCHEMA, lines(spark, sf_dir).select("date"))


N8 = VC + """,""" + VENDEURS_VALIDES_SQL + """,
bad AS (SELECT DISTINCT date FROM vc WHERE vendeur NOT IN (SELECT vendeur FROM vendeurs_valides)),
acc AS (SELECT * FROM vc WHERE date NOT IN (SELECT date FROM bad)
        AND date IN (SELECT date FROM vc GROUP BY date HAVING count(*) >= 5)),
e AS (SELECT *, round_even(montant * 0.42, 2) AS marge FROM acc)"""


@register("n8_daily_flow", N8 + ", k AS (" + g6_sql("e") + f""")
SELECT k.*, (SELECT CAST(sum(CAST(ca_total AS DECIMAL(18,2))) AS DOUBLE) FROM k) AS ca_cumule,
       (SELECT {snap('sum(CAST(taux_marge AS DECIMAL(18,4))) / count(taux_marge)', 1)} FROM k) AS taux_marge_moyen,
       (SELECT count(*) FROM k) AS nb_jours, (SELECT count(*) FROM vc, b WHERE date = d1) AS nb_raw_dernier
FROM k""")
def n8_daily_flow(spark, sf_dir):
    """The exported history after a replay, with the history totals and the
    raw rows of the last replayed day."""
    prefix, ok = unique_table("n8"), vendeurs_valides(spark, sf_dir)
    recon, hist, totals = replay(spark, sf_dir, lambda rows, days: J.daily_flow(
        spark, rows, ok, scratch_path(spark, "n8"), min_lignes=5, edges=EDGES, prefix=prefix, days=days))
    t = totals.select(F.struct(*totals.columns)).scalar()
    return hist.withColumns({c: t.getField(c) for c in totals.columns}).withColumn(
        "nb_raw_dernier", recon.agg(F.max("nb_raw")).scalar())


@register("n9_config_run", VC + """
SELECT date, CAST(sum(montant) AS DOUBLE) AS ca_total, count(*) AS nb_lignes,
       CASE WHEN sum(montant) < 800000 THEN 'ALERTE' ELSE 'RAS' END AS alerte,
       count(*) >= 10 AS volume_ok
FROM vc GROUP BY date""")
def n9_config_run(spark, sf_dir):
    """The alerts of every loaded day after a replay."""
    prefix, config = unique_table("n9"), '{"seuil_ca": 800000}'
    replay(spark, sf_dir, lambda rows, days: J.config_run(spark, rows, config, prefix, days))
    nothing = ventes(spark, sf_dir).limit(0)
    return J.config_run(spark, nothing, config, prefix)


@register("n10_region_fanout", W + _REGION_SQL.format(keys="date,", targets=REGION_TARGETS_SQL))
def n10_region_fanout(spark, sf_dir):
    return J.region_fanout(spark, ventes(spark, sf_dir), _targets(spark, REGION_TARGETS))


@register("n10_replay", VC + _REGION_SQL.format(keys="date,", targets=REGION_TARGETS_SQL).replace("FROM ventes v", "FROM vc v"))
def n10_replay(spark, sf_dir):
    """A replayed day that became empty, and regions of one that lost their
    rows, keep no KPI."""
    prefix, targets = unique_table("n10"), _targets(spark, REGION_TARGETS)
    return replay(spark, sf_dir, lambda rows, days: J.region_fanout(spark, rows, targets, prefix, days))


@register("n11_multi_source", API_SQL + """,
b AS (SELECT min(date) AS d0, max(date) AS d1 FROM ventes),
apic AS (SELECT a.* FROM api a, b WHERE date NOT IN (d0, d1) OR (date = d1 AND l_linenumber = 1)),
filesc AS (SELECT f.* FROM files f, b WHERE date <> d0),
cons AS (SELECT date, 'vendeur' AS dimension, vendeur AS valeur, sum(montant) AS ca, min(source) AS source
         FROM apic GROUP BY date, vendeur
         UNION ALL SELECT date, 'region', region, CAST(ca_region AS DECIMAL(18,2)), source FROM filesc)
SELECT 'vue' AS couche, date, dimension, valeur, CAST(ca AS DOUBLE) AS ca, source FROM cons
UNION ALL
SELECT 'total', date, NULL, CASE WHEN coalesce(t, 0) = 0 THEN 'N/A' ELSE printf('%.0f', CAST(round_even(t, 0) AS DOUBLE)) END,
       CAST(t AS DOUBLE), NULL
FROM (SELECT date, sum(ca) FILTER (WHERE dimension = 'vendeur') AS t FROM cons GROUP BY date)""")
def n11_multi_source(spark, sf_dir):
    """Replay with sellers removed from the last day, the first day gone;
    region files as Spark writes them, under a prefix that is a parameter."""
    prefix = unique_table("n11")

    def run(rows, days):
        folder = scratch_path(spark, "n11")
        files = region_files(spark, sf_dir)
        files = files.where(F.col("date") == days[1]) if days else files
        write_csv(files.coalesce(1) if days else files, f"{folder}/region_toutes.csv")
        return J.multi_source(spark, rows, folder, REGION_SCHEMA, file_prefix="part-", prefix=prefix, days=days)
    view, total = replay(spark, sf_dir, run, api_rows)
    text = F.lit(None).cast("string")
    return view.select(F.lit("vue").alias("couche"), "date", "dimension", "valeur",
                       F.col("ca").cast("double").alias("ca"), "source").unionByName(
        total.select(F.lit("total").alias("couche"), "date", text.alias("dimension"),
                     F.col("ca_texte").alias("valeur"), F.col("ca_total").alias("ca"), text.alias("source")))


_ACCEPTED_SQL = METRICS_SQL + """,
ok AS (SELECT date FROM ev GROUP BY date HAVING count(*) >= 10 AND bool_and(coalesce(v > 0, false)))"""


@register("n12_monitored_etl", _ACCEPTED_SQL + f""",
r AS (SELECT date, duree_totale_s, nb_lignes,
        sum(CAST(duree_totale_s AS DECIMAL(18,2))) OVER w AS md,
        sum(CAST(nb_lignes AS DECIMAL(18,2))) OVER w AS mv,
        count(*) OVER w AS c
      FROM metrics JOIN ok USING (date) WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT date, duree_totale_s, {snap('md / c', 4, even=False)} AS moyenne_duree_totale_s,
       c AS nb_jours_historique, c >= 3 AND CAST(duree_totale_s AS DECIMAL(18,2)) * c > md * 1.5 AS anomalie_perf,
       {snap('mv / c', 4, even=False)} AS moyenne_nb_lignes,
       c >= 2 AND nb_lignes * c < mv * 0.7 AS baisse_volume
FROM r""")
def n12_monitored_etl(spark, sf_dir):
    """Every seller is known here: the days whose amounts are positive load, and
    the history holds them alone."""
    return _n12(spark, sf_dir, all_known=True)["anomalies"]


@register("n12_rejected_day", _ACCEPTED_SQL + """,
b AS (SELECT min(date) AS d0, max(date) AS d1 FROM ev)
SELECT m.date, m.duree_totale_s, CASE WHEN m.date <> d1 AND ok.date IS NOT NULL THEN m.nb_lignes ELSE 0 END AS nb_lignes,
       CASE WHEN m.date <> d1 AND ok.date IS NOT NULL THEN m.ca_total ELSE 0.0 END AS ca_total,
       CASE WHEN m.date <> d1 AND ok.date IS NOT NULL THEN 'SUCCES' ELSE 'ECHEC' END AS statut
FROM metrics m CROSS JOIN b LEFT JOIN ok USING (date) WHERE m.date <> d0""")
def n12_rejected_day(spark, sf_dir):
    """Two days come again: the first without rows or stages, so that its
    metrics go; the last with a seller outside the domain, so that nothing of
    it loads and its metrics say ECHEC."""
    prefix = unique_table("n12")
    _n12(spark, sf_dir, all_known=True, prefix=prefix)
    days = table(spark, sf_dir, "events").agg(*(F.date_format(f("ts"), "yyyy-MM-dd") for f in (F.min, F.max))).first()
    out = _n12(spark, sf_dir, all_known=True, prefix=prefix, days=list(days), stranger=True)
    return out["metrics"].select("date", "duree_totale_s", "nb_lignes", "ca_total", "statut")


def _n12(spark, sf_dir, all_known=False, prefix=None, days=None, stranger=False):
    e = table(spark, sf_dir, "events")
    m = run_metrics_from_events(spark, sf_dir)
    stages = m.select("date", F.explode(F.array(*[
        F.struct(F.lit(s).alias("stage"), F.col(f"duree_{s}_s").alias("seconds"))
        for s in ("extract", "transform", "load")])).alias("x")).select("date", "x.*")
    day = F.date_format("ts", "yyyy-MM-dd").alias("date")
    sales = e.select(day, F.col("value").cast("decimal(18,2)").alias("montant"),
                     F.col("user_id").cast("string").alias("vendeur"))
    errors = e.groupBy(day).agg(F.count_if(F.col("event_type") == "error").alias("nb_erreurs"))
    if all_known:
        allowed = sales.select("vendeur").distinct()
    else:  # customers with a key that ends in 7 are not in the domain
        allowed = table(spark, sf_dir, "customer").where(F.pmod("c_custkey", F.lit(10)) != 7) \
            .select(F.col("c_custkey").cast("string").alias("vendeur"))
    if days:  # the last of them alone is delivered again
        sales, stages = (x.where(F.col("date") == days[-1]) for x in (sales, stages))
    if stranger:
        sales = sales.withColumn("vendeur", F.concat(F.lit("inconnu "), "vendeur"))
    return J.monitored_etl(spark, sales, allowed, stages, errors, edges=(0, 20, 60, float("inf")), limits=SLA_LIMITS,
                           prefix=prefix, days=days)


@register("n12_checks_and_load", f"""
WITH ev AS (SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(value AS DECIMAL(18,2)) AS m,
                   user_id IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 7) AS known FROM events),
c AS (SELECT date, count(*) AS n, sum(CASE WHEN m IS NULL THEN 1 ELSE 0 END) = 0 AS c1,
             bool_and(coalesce(m > 0, false)) AS c2, count(*) >= 10 AS c3, bool_and(known) AS c4 FROM ev GROUP BY date)
SELECT date, concat_ws(',', CASE WHEN NOT c1 THEN 'pas_de_nulls' END, CASE WHEN NOT c2 THEN 'montants_positifs' END,
                       CASE WHEN NOT c3 THEN 'volume_ok' END, CASE WHEN NOT c4 THEN 'vendeurs_valides' END) AS echecs,
       CASE WHEN c1 AND c2 AND c3 AND c4 THEN n ELSE 0 END AS nb_charges,
       CASE WHEN c1 AND c2 AND c3 AND c4 THEN
         (SELECT count(*) FROM ev WHERE ev.date = c.date AND m > 60) ELSE 0 END AS nb_large
FROM c""")
def n12_checks_and_load(spark, sf_dir):
    """The checks of each day and what the gate let into the table."""
    out = _n12(spark, sf_dir)
    loaded = out["loaded"].groupBy("date").agg(F.count(F.lit(1)).alias("nb_charges"),
                                               F.count_if(F.col("segment") == "Large").alias("nb_large"))
    return out["checks"].join(loaded, "date", "left").select(
        "date", F.array_join("checks_echoues", ",").alias("echecs"),
        F.coalesce("nb_charges", F.lit(0)).alias("nb_charges"), F.coalesce("nb_large", F.lit(0)).alias("nb_large"))


@register("n13_testable_etl", VC + """,""" + VENDEURS_VALIDES_SQL + f""",
bad AS (SELECT DISTINCT date FROM vc WHERE vendeur NOT IN (SELECT vendeur FROM vendeurs_valides)),
t AS (SELECT date, produit, {title_sql('vendeur')} AS vendeur, montant FROM vc
      WHERE date NOT IN (SELECT date FROM bad))
SELECT d.date, CAST(round_even(sum(montant), 2) AS DOUBLE) AS ca_total, count(*) AS nb_ventes,
       {snap('sum(montant) / count(montant)', 2)} AS panier_moyen,
       any_value(tp.top_produit) AS top_produit, any_value(tv.top_vendeur) AS top_vendeur
FROM t d LEFT JOIN {top_sql('t', 'produit')} tp USING (date)
         LEFT JOIN {top_sql('t', 'vendeur')} tv USING (date)
GROUP BY d.date""")
def n13_testable_etl(spark, sf_dir):
    prefix, ok = unique_table("n13"), vendeurs_valides(spark, sf_dir)
    return replay(spark, sf_dir, lambda rows, days: J.testable_etl(
        spark, rows, ok, EDGES, prefix, days, grouped=True), land=True)[1]


N14 = _G7_SQL.replace(W, VC).replace(
    "e AS (SELECT *, round_even(montant * 0.42, 2) AS marge FROM ventes)",
    f"""acc AS (SELECT * FROM vc WHERE date IN
          (SELECT date FROM vc GROUP BY date HAVING count(*) >= {MIN_LIGNES})),
e AS (SELECT *, round_even(montant * 0.42, 2) AS marge FROM acc)""")


def _n14(spark, sf_dir):
    prefix, targets = unique_table("n14"), objectifs_regions(spark, sf_dir)

    def run(rows, days):
        stages = rows.groupBy("date").agg(F.count(F.lit(1)).alias("a"), F.count_if(F.col("quantite") > 25).alias("b")) \
            .select("date", F.explode(F.array(
                F.struct(F.lit("extract").alias("stage"), F.col("a").cast("double").alias("seconds")),
                F.struct(F.lit("load").alias("stage"), F.col("b").cast("double").alias("seconds")))).alias("x")) \
            .select("date", "x.*")
        return J.final_etl(spark, rows, OBJECTIF, MIN_LIGNES, EDGES, stages=stages, targets=targets,
                           prefix=prefix, days=days)
    return replay(spark, sf_dir, run)


@register("n14_final_etl", N14 + f""",
dur AS (SELECT date, CAST(count(*) + count(*) FILTER (WHERE quantite > 25) AS DECIMAL(18,2)) AS s FROM acc GROUP BY date),
h AS (SELECT k.*, s, sum(s) OVER w AS t, count(*) OVER w AS c FROM k JOIN dur USING (date)
      WINDOW w AS (ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT date, ca_total, marge_totale, taux_marge, nb_ventes, panier_moyen, top_produit, top_vendeur,
       atteinte_obj, statut, CAST(s AS DOUBLE) AS duree_totale_s,
       {snap('t / c', 4, even=False)} AS moyenne_duree_totale_s, c AS nb_jours_historique,
       c >= 3 AND s * c > t * 1.5 AS anomalie_perf FROM h""")
def n14_final_etl(spark, sf_dir):
    """The KPI table after a replay, with the slow-run check."""
    out = _n14(spark, sf_dir)
    return out["kpis"].join(out["slow"].drop("duree_totale_s"), "date")


@register("n14_regions", N14 + "," + OBJECTIFS_SQL + f""",
a AS (SELECT date, region, sum(montant) AS ca, count(*) AS n FROM acc GROUP BY 1, 2)
SELECT o.date, o.region, CAST(o.objectif_region AS DOUBLE) AS objectif_region,
       CAST(coalesce(a.ca, 0) AS DOUBLE) AS ca_region, coalesce(a.n, 0) AS nb_ventes,
       {snap('coalesce(a.ca, 0) * 100 / o.objectif_region', 1)} AS atteinte_pct
FROM objectifs o LEFT JOIN a ON o.date = a.date AND o.region = a.region""")
def n14_regions(spark, sf_dir):
    """The clean layer after a replay against the regions' targets."""
    return _n14(spark, sf_dir)["regions"]


@register("n15_day_routing", W + f""",
d AS (SELECT date, sum(montant) AS ca, count(*) AS n FROM ventes GROUP BY date),
r AS (SELECT *, CASE WHEN ca >= {ROUTE_LIMITS[0]} THEN 'traitement_gros_volume'
                     WHEN ca >= {ROUTE_LIMITS[1]} THEN 'traitement_volume_moyen'
                     ELSE 'traitement_faible_volume' END AS traitement FROM d)
SELECT traitement, CAST(sum(n) AS BIGINT) AS nb_lignes, count(*) AS nb_jours FROM r GROUP BY traitement""")
def n15_day_routing(spark, sf_dir):
    return J.day_routing(spark, ventes(spark, sf_dir), scratch_path(spark, "n15"), ROUTE_LIMITS)


@register("n16_file_check", WB + """
SELECT date, count(*) AS nb_lignes, CAST(sum(montant) AS DOUBLE) AS ca_brut, count(*) > 0 AS is_valid
FROM ventes_brutes GROUP BY date""")
def n16_file_check(spark, sf_dir):
    path = scratch_path(spark, "n16")
    ventes_brutes(spark, sf_dir).select("date", "produit", "vendeur", "montant", "remise") \
        .write.option("header", True).csv(path)
    return J.file_check(spark, path, "date string, produit string, vendeur string, "
                                     "montant decimal(18,2), remise double")
