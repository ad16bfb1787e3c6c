"""Sinks and load semantics, checked on the final state."""

from pyspark.sql import functions as F

from salesflow.layout import by_day
from salesflow.operators import kpis as K
from salesflow.operators import quality as Q
from salesflow.operators.enrich import with_lineage
from salesflow.operators.states import apply_delta
from salesflow.registry import register
from salesflow.registry._sql import OBJECTIF, W
from salesflow.registry.q_kpis import _G7_SQL, kpis_final_today
from salesflow.registry.q_sources import VENTES_DDL, load_ventes_table
from salesflow.session import scratch_path, unique_table
from salesflow.sinks import (MONTH, append_by_name, append_with_ids, ensure_table, export_report,
                             log_events, replace_day, replace_days, rows_of, upsert_kpis,
                             write_csv)
from salesflow.sources import read_csv, scan
from salesflow.views import lines, table, ventes

KPI_SCHEMA = ("date string, ca_total double, marge_totale double, taux_marge double, "
              "nb_ventes bigint, panier_moyen double, top_produit string, top_vendeur string, "
              "atteinte_obj double, statut string")
VENTES_COLS = [c.split()[0] for c in VENTES_DDL.split(", ")]
OUT = ["date", "l_orderkey", "l_linenumber", "montant", "vendeur", "region"]


def _out(df):
    return df.select(*OUT).withColumn("montant", F.col("montant").cast("double"))


@register("b1_write_csv", _G7_SQL + "\nSELECT * FROM k")
def b1_write_csv(spark, sf_dir):
    path = write_csv(kpis_final_today(spark, sf_dir), scratch_path(spark, "b1"))
    return read_csv(spark, path, KPI_SCHEMA)


@register("b2_ensure_table", W + """
SELECT date, l_orderkey, l_linenumber, CAST(montant AS DOUBLE) AS montant, vendeur, region
FROM ventes""")
def b2_ensure_table(spark, sf_dir):
    """Creating twice is a no-op; the table then holds one load."""
    name = unique_table("ventes")
    ensure_table(spark, name, VENTES_DDL)
    ensure_table(spark, name, VENTES_DDL)
    append_by_name(spark, ventes(spark, sf_dir).select(*VENTES_COLS), name)
    return _out(spark.table(name))


@register("b3_append_by_name", W + """
SELECT date, l_orderkey, l_linenumber, CAST(montant AS DOUBLE) AS montant, vendeur,
       CASE WHEN l_linestatus = 'F' THEN region END AS region
FROM ventes""")
def b3_append_by_name(spark, sf_dir):
    """Two appends with columns in another order; the second lacks
    ``region`` (null), as a by-name append allows.  An append-only table
    needs no partitioning: each append adds files, nothing is replaced."""
    name = unique_table("ventes")
    ensure_table(spark, name, VENTES_DDL, partition=None)
    v = ventes(spark, sf_dir)
    first = v.where(F.col("l_linestatus") == "F").select(*reversed(VENTES_COLS))
    second = v.where(F.col("l_linestatus") != "F").select(
        *[c for c in VENTES_COLS if c != "region"])
    append_by_name(spark, first, name)
    append_by_name(spark, second, name)
    return _out(spark.table(name))


@register("b4_replace_day", W + """,
b AS (SELECT min(date) AS d0, max(date) AS d1 FROM ventes)
SELECT date, l_orderkey, l_linenumber, CAST(montant AS DOUBLE) AS montant, vendeur, region
FROM ventes, b
WHERE date <> d1 AND (date <> d0 OR l_linestatus = 'F')""")
def b4_replace_day(spark, sf_dir):
    """Load every day twice (idempotent), then replace the first day with
    its finished lines only and the last day with nothing (cleared).  The
    sales are joined and grouped by day once."""
    v = by_day(spark, ventes(spark, sf_dir).select(*VENTES_COLS, "l_linestatus"))
    name = load_ventes_table(spark, sf_dir, rows=v)
    replace_days(spark, v.select(*VENTES_COLS), name, grouped=True)
    d0, d1 = v.agg(F.min("date"), F.max("date")).first()
    replace_day(spark, v.where((F.col("date") == d0) & (F.col("l_linestatus") == "F"))
                .select(*VENTES_COLS), name, d0)
    replace_day(spark, v.where(F.lit(False)).select(*VENTES_COLS), name, d1)
    return _out(spark.table(name))


@register("b5_upsert_kpis", W + """,
allk AS (SELECT date, CAST(sum(montant) AS DOUBLE) AS ca_total, count(*) AS nb_ventes
         FROM ventes GROUP BY date),
openk AS (SELECT date, CAST(sum(montant) AS DOUBLE) AS ca_total, count(*) AS nb_ventes
          FROM ventes WHERE l_linestatus = 'O' GROUP BY date)
SELECT * FROM allk WHERE date NOT IN (SELECT date FROM openk)
UNION ALL SELECT * FROM openk""")
def b5_upsert_kpis(spark, sf_dir):
    """KPIs of all lines, then an upsert of KPIs recomputed on open lines:
    the dates they cover are replaced, the others kept."""
    v = ventes(spark, sf_dir)
    name = unique_table("kpis")
    ensure_table(spark, name, "date string, ca_total double, nb_ventes bigint", partition=MONTH)
    upsert_kpis(spark, K.day_totals(v), name)
    upsert_kpis(spark, K.day_totals(v.where(F.col("l_linestatus") == "O")), name)
    return rows_of(spark, name)


@register("b4_replace_days_clear", W + """,
b AS (SELECT min(date) AS d0, max(date) AS d1 FROM ventes)
SELECT date, l_orderkey, l_linenumber, CAST(montant AS DOUBLE) AS montant, vendeur, region
FROM ventes, b WHERE date <> d1 AND (date <> d0 OR l_linenumber = 1)""")
def b4_replace_days_clear(spark, sf_dir):
    """Load all, clear the first and the last day (listed, no rows), then
    append the first day's first lines: nothing old comes back."""
    v = ventes(spark, sf_dir).select(*VENTES_COLS)
    name = load_ventes_table(spark, sf_dir)
    d0, d1 = lines(spark, sf_dir).agg(F.min("date"), F.max("date")).first()
    replace_days(spark, v.limit(0), name, days=[d0, d1])
    append_by_name(spark, v.where((F.col("date") == d0) & (F.col("l_linenumber") == 1)), name)
    return _out(spark.table(name))


EVENTS_DDL = "date string, horodatage string, type_event string, task_id string, detail string"


def _event_rows(e):
    return e.select(F.date_format("ts", "yyyy-MM-dd").alias("date"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("horodatage"),
                    F.upper("event_type").alias("type_event"),
                    F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("task_id"),
                    F.col("props").alias("detail"))


@register("b5_state_deltas", _G7_SQL.replace("FROM ventes),", "FROM ventes WHERE NOT (l_returnflag = 'R' AND l_linenumber < 4)),", 1)
          + "\nSELECT * FROM k")
def b5_state_deltas(spark, sf_dir):
    """KPIs kept up by deltas of states: a first load, rows that come later,
    returned lines that go, the last delta run twice.  Equal to the KPIs of the
    rows that are left."""
    states, kpis = unique_table("states"), unique_table("kpis")
    ensure_table(spark, kpis, KPI_SCHEMA, partition=MONTH)
    v = by_day(spark, ventes(spark, sf_dir).select("date", "produit", "vendeur", "montant", "l_linenumber", "l_returnflag"))
    late, back = F.col("l_linenumber") == 2, (F.col("l_returnflag") == "R") & (F.col("l_linenumber") < 4)
    apply_delta(spark, v.where(~late), None, states, kpis, "a", OBJECTIF)
    apply_delta(spark, v.where(late), None, states, kpis, "b", OBJECTIF)
    for _ in range(2):
        apply_delta(spark, None, v.where(back), states, kpis, "c", OBJECTIF)
    return rows_of(spark, kpis)


@register("b6_log_events", """
SELECT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%Y-%m-%d %H:%M:%S') AS horodatage,
       upper(event_type) AS type_event, 'user_' || CAST(user_id AS VARCHAR) AS task_id,
       props AS detail FROM events""")
def b6_log_events(spark, sf_dir):
    """Two appends (failures, then the rest) to an append-only log."""
    name = unique_table("events")
    ensure_table(spark, name, EVENTS_DDL)
    e = table(spark, sf_dir, "events")
    log_events(spark, _event_rows(e.where(F.col("event_type") == "error")), name)
    log_events(spark, _event_rows(e.where(F.col("event_type") != "error")), name)
    return spark.table(name)


@register("b7_surrogate_key", W + """,
f AS (SELECT *, row_number() OVER (ORDER BY date, l_orderkey, l_linenumber, montant) AS rn
      FROM ventes WHERE l_linestatus = 'F'),
o AS (SELECT *, (SELECT count(*) FROM f) +
             row_number() OVER (ORDER BY date, l_orderkey, l_linenumber, montant) AS rn
      FROM ventes WHERE l_linestatus <> 'F')
SELECT rn AS id, l_orderkey, l_linenumber, CAST(montant AS DOUBLE) AS montant FROM f
UNION ALL SELECT rn, l_orderkey, l_linenumber, CAST(montant AS DOUBLE) FROM o""")
def b7_surrogate_key(spark, sf_dir):
    """Two loads into a table, ids continuing from the stored mark; only the
    columns of the table are sorted, from rows written once."""
    path = scratch_path(spark, "b7")
    ventes(spark, sf_dir).select("date", "l_orderkey", "l_linenumber", "montant", "l_linestatus").write.parquet(path)
    v = spark.read.parquet(path)
    order = ["date", "l_orderkey", "l_linenumber", "montant"]
    name, marks = unique_table("ids"), unique_table("marks")
    ensure_table(spark, name, "id bigint, l_orderkey bigint, l_linenumber int, montant decimal(18,2), date string",
                 partition=None)
    for load in (v.where(F.col("l_linestatus") == "F"), v.where(F.col("l_linestatus") != "F")):
        append_with_ids(spark, load.drop("l_linestatus"), name, order, marks)
    return spark.table(name).select("id", "l_orderkey", "l_linenumber", F.col("montant").cast("double").alias("montant"))


@register("b8_with_lineage", W + """
SELECT l_orderkey, l_linenumber, 'SOURCE_PRINCIPALE' AS source, true AS horodate FROM ventes""")
def b8_with_lineage(spark, sf_dir):
    v = with_lineage(ventes(spark, sf_dir), "SOURCE_PRINCIPALE")
    return v.select("l_orderkey", "l_linenumber", "source",
                    F.col("charge_le").isNotNull().alias("horodate"))


@register("b9_export_report", _G7_SQL + """
SELECT date, ca_total, marge_totale, taux_marge, nb_ventes, top_produit, top_vendeur FROM k""")
def b9_export_report(spark, sf_dir):
    cols = ["date", "ca_total", "marge_totale", "taux_marge", "nb_ventes",
            "top_produit", "top_vendeur"]
    k = kpis_final_today(spark, sf_dir)
    ds = k.agg(F.max("date")).first()[0]
    path = export_report(k, scratch_path(spark, "b9"), ds, cols)
    assert path.endswith(f"rapport_mensuel_{ds[:7]}")
    return read_csv(spark, path, "date string, ca_total double, marge_totale double, "
                    "taux_marge double, nb_ventes bigint, top_produit string, top_vendeur string")


@register("e9_verify_loaded", W + """,
b AS (SELECT max(date) AS d1 FROM ventes)
SELECT date, CASE WHEN date = d1 THEN 0 ELSE count(*) END AS nb_lignes, date <> d1 AS ok
FROM ventes, b GROUP BY date, d1""")
def e9_verify_loaded(spark, sf_dir):
    """Every day was to be loaded; the last one got lost."""
    name = load_ventes_table(spark, sf_dir)
    days = lines(spark, sf_dir).select("date")
    replace_days(spark, spark.createDataFrame([], spark.table(name).schema), name,
                 days=[days.agg(F.max("date")).first()[0]])
    return Q.verify_loaded(scan(spark, name), expected=days)
