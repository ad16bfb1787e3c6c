"""Run metrics and history checks over the event log."""

from pyspark.sql import functions as F

from salesflow.functions.dates import day_key
from salesflow.functions.numeric import ratio
from salesflow.operators import monitoring as M
from salesflow.registry import register
from salesflow.registry._sql import snap
from salesflow.views import table

# Stand-in for the pipeline's stage timings: per day, the mean value of
# three event types, as seconds.  Time limits scaled to that unit.
STAGE_OF_EVENT = (("view", "extract"), ("click", "transform"), ("purchase", "load"))
SLA_LIMITS = {"extract": 55, "task": 60, "run": 160}


def run_metrics_from_events(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        day_key("ts").alias("date"), "event_type", F.col("value").cast("decimal(18,2)").alias("v"))
    stage = F.lit(None).cast("string")
    for ev, st in STAGE_OF_EVENT:
        stage = F.when(F.col("event_type") == ev, F.lit(st)).otherwise(stage)
    stages = e.withColumn("stage", stage).where(F.col("stage").isNotNull()) \
        .groupBy("date", "stage").agg(ratio(F.sum("v"), F.count(F.lit(1)), scale=2).alias("seconds"))
    sales = e.select("date", F.col("v").alias("montant"))
    errors = e.groupBy("date").agg(F.count_if(F.col("event_type") == "error").alias("nb_erreurs"))
    return M.run_metrics(stages, sales, errors=errors)


METRICS_SQL = f"""WITH
ev AS (SELECT strftime(ts, '%Y-%m-%d') AS date, event_type, CAST(value AS DECIMAL(18,2)) AS v FROM events),
st AS (SELECT date, CASE event_type WHEN 'view' THEN 'extract' WHEN 'click' THEN 'transform'
                                    WHEN 'purchase' THEN 'load' END AS stage,
              CAST({snap('sum(v) / count(*)', 2)} AS DECIMAL(18,2)) AS s
       FROM ev WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1, 2),
w AS (SELECT date, coalesce(max(s) FILTER (WHERE stage = 'extract'), 0) AS e,
             coalesce(max(s) FILTER (WHERE stage = 'transform'), 0) AS t,
             coalesce(max(s) FILTER (WHERE stage = 'load'), 0) AS l FROM st GROUP BY date),
vol AS (SELECT date, count(*) AS nb_lignes, CAST(round(sum(v), 2) AS DOUBLE) AS ca_total,
               count(*) FILTER (WHERE event_type = 'error') AS nerr FROM ev GROUP BY date),
metrics AS (
  SELECT w.date, CAST(e AS DOUBLE) AS duree_extract_s, CAST(t AS DOUBLE) AS duree_transform_s,
         CAST(l AS DOUBLE) AS duree_load_s, CAST(round(e + t + l, 2) AS DOUBLE) AS duree_totale_s,
         coalesce(nb_lignes, 0) AS nb_lignes, ca_total,
         CASE WHEN nb_lignes > 0 THEN {snap('nerr / nb_lignes', 4, even=False)}
              ELSE 0.0 END AS taux_erreur,
         'SUCCES' AS statut
  FROM w LEFT JOIN vol USING (date))"""


@register("g16_run_metrics", METRICS_SQL + "\nSELECT * FROM metrics")
def g16_run_metrics(spark, sf_dir):
    return run_metrics_from_events(spark, sf_dir)


def _rolling_sql(n, k, min_days, value, name, op):
    return METRICS_SQL + f""",
r AS (SELECT date, {value},
             sum(CAST({value} AS DECIMAL(18,2))) OVER w AS m,
             count(*) OVER w AS c
      FROM metrics WINDOW w AS (ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW))
SELECT date, {value}, {snap('m / c', 4, even=False)} AS moyenne_{value}, c AS nb_jours_historique,
       c >= {min_days} AND CAST({value} AS DECIMAL(18,2)) * c {op} m * {k} AS {name}
FROM r"""


@register("h1_perf_anomaly", _rolling_sql(7, 1.5, 3, "duree_totale_s", "anomalie_perf", ">"))
def h1_perf_anomaly(spark, sf_dir):
    return M.perf_anomaly(run_metrics_from_events(spark, sf_dir), n=7, k=1.5, min_days=3)


@register("h2_volume_anomaly", _rolling_sql(7, 0.7, 2, "nb_lignes", "baisse_volume", "<"))
def h2_volume_anomaly(spark, sf_dir):
    return M.volume_anomaly(run_metrics_from_events(spark, sf_dir), n=7, k=0.7, min_days=2)


@register("h3_perf_anomaly_10", _rolling_sql(10, 1.5, 3, "duree_totale_s", "anomalie_perf", ">"))
def h3_perf_anomaly_10(spark, sf_dir):
    return M.perf_anomaly(run_metrics_from_events(spark, sf_dir), n=10, k=1.5, min_days=3)


@register("h4_sla_breaches", METRICS_SQL + f""",
long AS (SELECT date, 'extract' AS etape, duree_extract_s AS duree_s FROM metrics UNION ALL
         SELECT date, 'transform', duree_transform_s FROM metrics UNION ALL
         SELECT date, 'load', duree_load_s FROM metrics UNION ALL
         SELECT date, 'run', duree_totale_s FROM metrics),
lim AS (SELECT *, CAST(CASE etape WHEN 'run' THEN {SLA_LIMITS['run']}
                             WHEN 'extract' THEN {min(SLA_LIMITS['extract'], SLA_LIMITS['task'])}
                             ELSE {SLA_LIMITS['task']} END AS DOUBLE) AS limite_s FROM long)
SELECT * FROM lim WHERE duree_s > limite_s""")
def h4_sla_breaches(spark, sf_dir):
    return M.sla_breaches(run_metrics_from_events(spark, sf_dir), SLA_LIMITS)


@register("g17_history_mean", METRICS_SQL + f"""
SELECT {snap('sum(CAST(duree_totale_s AS DECIMAL(18,2))) / count(*)', 2)} AS duree_moyenne_s,
       {snap('sum(nb_lignes) / count(*)', 2)} AS volume_moyen
FROM metrics""")
def g17_history_mean(spark, sf_dir):
    return M.history_mean(run_metrics_from_events(spark, sf_dir))
