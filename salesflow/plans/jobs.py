"""The reference's daily pipelines as Spark jobs.

Each job takes DataFrames (or folders) and parameters, runs for every
date present at once, writes what the reference writes (CSV exports,
date-partitioned tables, KPI tables) and returns its reports as
DataFrames.  Orchestration (scheduling, retries, sensors, branches) is
not rebuilt: a branch becomes a label, a sensor a stream trigger.

Jobs that load tables take a ``prefix`` for the tables' names, so that
tomorrow's run finds today's history (none: fresh tables), and ``days``,
the run dates: a run date without (valid) rows is cleared, so a replay
gives the state of a first run.  ``gate`` says what an invalid day does:
``"quarantine"`` keeps it out of the clean layer, ``"stop"`` raises with
the full report written out.  ``grouped``: the rows of a day lie together
(``layout.by_day``), so that a load by day needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.functions.labels import DEFAULT_EDGES
from salesflow.functions.numeric import MONEY
from salesflow.operators import consolidate as C
from salesflow.operators import enrich as En
from salesflow.operators import kpis as K
from salesflow.operators import monitoring as M
from salesflow.operators import quality as Q
from salesflow.operators import reports as Rp
from salesflow.operators import routing as Ro
from salesflow.session import unique_table
from salesflow.sinks import (MONTH, ensure_table, export_report, replace_days, rows_of, upsert_kpis,
                             write_csv)
from salesflow.sources import read_available, read_csv, read_json_records, read_many
from salesflow.sources.config import parse_config
from salesflow.streaming import ingest_arrivals

Days = Sequence[str] | None
VENTES_DDL = ("date string, produit string, categorie string, vendeur string, region string, "
              "quantite int, montant decimal(18,2), charge_le timestamp")
CLEAN_DDL = ("date string, produit string, categorie string, vendeur string, region string, "
             "quantite int, montant decimal(18,2), marge decimal(18,2), taille_vente string, "
             "charge_le timestamp")
FINAL_DDL = ("date string, produit string, categorie string, vendeur string, region string, "
             "quantite int, montant decimal(18,2), marge decimal(18,2), taux_marge double, "
             "taille_vente string, source string, charge_le timestamp")
METRICS_DDL = ("date string, duree_extract_s double, duree_transform_s double, duree_load_s double, "
               "duree_totale_s double, nb_lignes bigint, ca_total double, taux_erreur double, "
               "statut string")


def _ddl_cols(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def _tables(prefix: str | None, *names: str) -> list[str]:
    prefix = prefix or unique_table("job")
    return [f"{prefix}_{n}" for n in names]


def _load(spark: SparkSession, df: DataFrame, table: str, ddl: str, days: Days, grouped: bool = False) -> DataFrame:
    """B2 + B4: the columns of ``ddl`` into their table; those days of it."""
    ensure_table(spark, table, ddl)
    replace_days(spark, df.select(*_ddl_cols(ddl)), table, days=days, grouped=grouped)
    return _run_days(spark.table(table), days)


def _run_days(df: DataFrame, days: Days) -> DataFrame:
    return df.where(F.col("date").isin(list(days))) if days else df


def _gate(rows: DataFrame, report: DataFrame, gate: str, grouped: bool = False) -> DataFrame:
    """The rows that pass; ``"stop"`` raises if a day does not."""
    if gate == "stop":
        Q.require_valid(report)
        return rows
    if gate != "quarantine":
        raise ValueError("gate is 'stop' or 'quarantine'")
    return Q.quarantine(rows, report, bounded=grouped)[0]  # a report has a row a day


def simple_etl(spark: SparkSession, raw: DataFrame, out: str,
               edges: Sequence[float] = DEFAULT_EDGES) -> DataFrame:
    """Margin 0.40 (integer), size class, title-cased seller, CSV."""
    t = En.with_margin(raw, 0.40, 0, as_int=True)
    t = En.with_title_case(En.with_size_class(t, edges), "vendeur")
    write_csv(t, out)
    return read_csv(spark, out, t.schema)


def seller_performance_report(spark: SparkSession, inbox: str, schema: str, target: str,
                              checkpoint: str, out: str) -> tuple[DataFrame, DataFrame]:
    """The performance files that arrived in ``inbox`` (taken once),
    attainment and two-way status per row as CSV, and the overall ratio of
    sums.  Returns (report, overall)."""
    perf = ingest_arrivals(spark, inbox, schema, target, checkpoint, file_glob="*.csv").drop("_file", "batch")
    rep = Rp.seller_performance(perf)
    write_csv(rep, out)
    back = read_csv(spark, out, rep.schema)
    return back, Rp.overall_attainment(back)


def regional_consolidation(spark: SparkSession, paths: Sequence[str], schema: str, out: str
                           ) -> tuple[DataFrame, DataFrame]:
    """Tolerant read of the regional files, concatenation written as
    CSV, then the day totals (CA of the files, number of rows).  Returns
    (concatenated rows, totals)."""
    df = C.concat([read_available(spark, paths, schema)]).drop("_file")
    write_csv(df, out)
    rows = read_csv(spark, out, df.schema)
    tot = rows.groupBy("date").agg(F.sum(F.col("ca_region").cast(MONEY)).cast("double").alias("ca_total"),
                                   F.count(F.lit(1)).alias("nb_lignes"))
    return rows, tot


def warehouse_reports(spark: SparkSession, sales: DataFrame, out: str, prefix: str | None = None,
                      days: Days = None, expected: DataFrame | None = None, stop: bool = False
                      ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Create the table, load every day idempotently with lineage,
    verify the ``expected`` days (default: the input's; ``stop`` raises on an
    empty one), then the seller and category reports over the whole table,
    as CSV.  Returns (verification, seller report, category report)."""
    (table,) = _tables(prefix, "ventes")
    mine = _load(spark, En.with_lineage(sales), table, VENTES_DDL, days)
    want = sales.select("date") if expected is None else expected
    check = Q.verify_loaded(mine, expected=want, stop=stop)
    loaded = spark.table(table)
    seller, cat = Rp.report_by_seller(loaded), Rp.report_by_category(loaded)
    write_csv(seller, f"{out}/rapport_vendeur")
    write_csv(cat, f"{out}/rapport_categorie")
    return (check, read_csv(spark, f"{out}/rapport_vendeur", seller.schema),
            read_csv(spark, f"{out}/rapport_categorie", cat.schema))


def json_ingest(spark: SparkSession, folder: str, schema: str, cols: Sequence[str], out: str,
                n: int = 5) -> DataFrame:
    """JSON records -> kept columns -> CSV; preview of the first rows
    (ordered by the first column)."""
    df = read_json_records(spark, folder, schema, cols)
    write_csv(df, out)
    return read_csv(spark, out, df.schema).orderBy(cols[0]).limit(n)


def load_guard(spark: SparkSession, sales: DataFrame, prefix: str | None = None, days: Days = None,
               expected: DataFrame | None = None, stop: bool = False,
               edges: Sequence[float] = DEFAULT_EDGES) -> DataFrame:
    """Margin 0.42 (integer), size class, idempotent load, then the
    row count of each ``expected`` day (default: the input's) with the
    zero-row failure flag; ``stop`` raises on it."""
    (table,) = _tables(prefix, "ventes_tf")
    t = En.with_size_class(En.with_margin(sales, 0.42, 0, as_int=True), edges)
    mine = _load(spark, t, table, "date string, produit string, vendeur string, quantite int, "
                                  "montant decimal(18,2), marge int, taille_vente string", days)
    want = sales.select("date") if expected is None else expected
    return Q.verify_loaded(mine, expected=want, stop=stop)


def regional_kpis(spark: SparkSession, paths: Sequence[str], schema: str, calendar: DataFrame,
                  prefix: str | None = None, limits=(80000, 50000)) -> DataFrame:
    """Tolerant read of the regional extracts, consolidated KPIs (CA,
    number of sellers, strict status) for each date of ``calendar``, keyed
    upsert.  A date without rows, or no file at all, is ``vide``."""
    df = read_available(spark, paths, schema, on_empty="none")
    df = spark.createDataFrame([], schema) if df is None else df
    k = K.with_empty_defaults(K.consolidated_kpis(df, limits=limits), calendar,
                              defaults={"ca_total": 0, "nb_vendeurs": 0, "statut": "vide"})
    (table,) = _tables(prefix, "kpis_regions")
    ensure_table(spark, table, "date string, ca_total bigint, nb_vendeurs bigint, statut string",
                 partition=MONTH)
    upsert_kpis(spark, k, table)
    return rows_of(spark, table)


def daily_flow(spark: SparkSession, raw: DataFrame, allowed: DataFrame, out: str,
               min_lignes: int = 5, edges: Sequence[float] = DEFAULT_EDGES,
               prefix: str | None = None, days: Days = None, gate: str = "quarantine",
               stop_on_gap: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw load -> validation gate -> enrichment -> clean load -> SQL
    KPIs -> KPI upsert -> layer reconciliation -> history export and totals.

    The gate is per day (nulls, non-positive amounts, fewer than
    ``min_lignes`` rows, unknown sellers); the raw layer keeps everything.
    ``stop_on_gap`` raises when a layer lacks a day.  The history table holds
    the days of all runs.  Returns (reconciliation of this run's days,
    exported history, history totals)."""
    raw_t, clean_t, kpi_t = _tables(prefix, "ventes_raw", "ventes_clean", "kpis_journaliers")
    ensure_table(spark, kpi_t, "date string, ca_total double, marge_totale double, "
                               "taux_marge double, nb_ventes bigint, top_produit string, "
                               "top_vendeur string", partition=MONTH)
    loaded = _load(spark, En.with_lineage(raw), raw_t, VENTES_DDL, days)
    report = Q.validate_testable(loaded.drop("charge_le"), allowed)
    report = report.withColumn("valid", F.col("valid") & (F.col("nb_lignes") >= min_lignes))
    accepted = _gate(loaded, report, gate)
    clean = _load(spark, En.with_lineage(En.with_size_class(En.with_margin(accepted), edges)),
                  clean_t, CLEAN_DDL, days)
    upsert_kpis(spark, K.kpis_sql(clean), kpi_t, days=days)
    kpis = rows_of(spark, kpi_t)
    recon = Q.reconcile({"raw": loaded, "clean": clean, "kpis": _run_days(kpis, days)}, stop=stop_on_gap)
    ds = kpis.agg(F.max("date")).first()[0]
    path = export_report(kpis, out, ds or "0000-00")
    return recon, read_csv(spark, path, kpis.schema), Rp.history_summary(kpis)


def config_run(spark: SparkSession, sales: DataFrame, config_json: str, prefix: str | None = None,
               days: Days = None) -> DataFrame:
    """JSON configuration with defaults, the sales loaded day by day,
    and per loaded day the alert against the configured threshold."""
    cfg = spark.createDataFrame([(config_json,)], "raw string").select(
        parse_config("raw", "seuil_ca double, nb_lignes_min int",
                     {"seuil_ca": 5000.0, "nb_lignes_min": 10}).alias("c"))
    (table,) = _tables(prefix, "ventes_config")
    mine = _load(spark, En.with_lineage(sales), table, VENTES_DDL, days)
    daily = mine.groupBy("date").agg(F.sum(F.col("montant").cast(MONEY)).alias("_ca"),
                                     F.count(F.lit(1)).alias("nb_lignes"))
    c = cfg.scalar()  # the one configuration row, as a scalar subquery
    return daily.select("date", F.col("_ca").cast("double").alias("ca_total"), "nb_lignes",
                        F.when(F.col("_ca") < c.getField("seuil_ca"), F.lit(Ro.ALERT))
                         .otherwise(F.lit(Ro.NO_ALERT)).alias("alerte"),
                        (F.col("nb_lignes") >= c.getField("nb_lignes_min")).alias("volume_ok"))


def region_fanout(spark: SparkSession, sales: DataFrame, targets: DataFrame,
                  prefix: str | None = None, days: Days = None) -> DataFrame:
    """Every configured region in one job (the reference generates
    one pipeline per region): CA, attainment, status, keyed upsert on
    (date, region).  All KPIs of the run ``days`` are replaced: a day or a
    region of it that has no rows any more keeps none."""
    rep = Rp.region_attainment(sales, targets)
    (table,) = _tables(prefix, "kpis_region")
    ensure_table(spark, table, "date string, region string, ca double, atteinte double, "
                               "statut string", partition=MONTH)
    upsert_kpis(spark, rep, table, key=["date", "region"], days=days)
    return rows_of(spark, table)


def multi_source(spark: SparkSession, api: DataFrame, files_folder: str, files_schema: str,
                 file_prefix: str = "region_", file_suffix: str = ".csv", prefix: str | None = None,
                 days: Days = None) -> tuple[DataFrame, DataFrame]:
    """API rows (with fallback already applied) and the region files
    ``<file_prefix>*<file_suffix>`` of a folder replace their days in their
    tables, the long consolidated view is rebuilt from the tables for these
    days and replaces them, and the daily seller total is reported.  No
    matching file: the API rows alone.  Returns (consolidated view, totals)."""
    api_t, files_t, cons_t = _tables(prefix, "source_api", "source_fichiers", "consolide")
    mine = _load(spark, api, api_t, "date string, vendeur string, produit string, "
                                    "montant decimal(18,2), source string", days)
    files = read_many(spark, files_folder, files_schema, prefix=file_prefix, suffix=file_suffix)
    files = spark.createDataFrame([], files_schema) if files is None else files.drop("_file")
    regions = _load(spark, files, files_t, "date string, region string, ca_region decimal(18,2), "
                                           "nb_ventes bigint, source string", days)
    _load(spark, C.consolidate(mine, regions), cons_t,
          "date string, dimension string, valeur string, ca decimal(18,2), source string", days)
    view = spark.table(cons_t)
    return view, C.consolidated_total(view)


def monitored_etl(spark: SparkSession, sales: DataFrame, allowed: DataFrame, stages: DataFrame,
                  errors: DataFrame | None = None, min_lignes: int = 10,
                  edges: Sequence[float] = DEFAULT_EDGES, limits: dict | None = None,
                  prefix: str | None = None, days: Days = None, gate: str = "quarantine"
                  ) -> dict[str, DataFrame]:
    """Health checks as a gate, margin, English segment, idempotent
    load, run metrics per day upserted, then over the metrics history the
    anomaly report (slow run, volume drop) and the time-limit breaches.

    The metrics are those of the loaded rows.  A day that the gate rejects
    has loaded nothing: its row says ``ECHEC`` and stays out of the history
    that the anomalies are judged by.  Returns ``checks``, ``loaded``, ``metrics``,
    ``anomalies``, ``breaches``."""
    sales_t, met_t = _tables(prefix, "ventes_monitoring", "metriques_pipeline")
    checks = Q.health_checks(sales, allowed, min_lignes)
    report = checks.withColumn("valid", F.size("checks_echoues") == 0)
    if gate == "stop":
        Q.require_valid(report, errors="checks_echoues")
    accepted = _gate(sales, report, "quarantine")
    rows = En.with_lineage(En.with_segment(En.with_margin(accepted), edges))
    loaded = _load(spark, rows, sales_t, "date string, vendeur string, montant decimal(18,2), "
                                         "marge decimal(18,2), segment string, charge_le timestamp", days)
    ensure_table(spark, met_t, METRICS_DDL, partition=MONTH)
    metrics = M.run_metrics(stages, accepted, errors=errors, rejected=report.where(~F.col("valid")))
    upsert_kpis(spark, metrics, met_t, days=days)
    hist = rows_of(spark, met_t)
    done = hist.where(F.col("statut") == M.STATUS_OK)
    anomalies = M.perf_anomaly(done).join(
        M.volume_anomaly(done).drop("nb_lignes", "nb_jours_historique"), "date")
    return {"checks": checks, "loaded": loaded, "metrics": hist, "anomalies": anomalies,
            "breaches": M.sla_breaches(hist, limits)}


def testable_etl(spark: SparkSession, sales: DataFrame, allowed: DataFrame,
                 edges: Sequence[float] = DEFAULT_EDGES, prefix: str | None = None, days: Days = None,
                 gate: str = "quarantine", grouped: bool = False) -> tuple[DataFrame, DataFrame]:
    """Validation gate, transform (margin, rate, size class, title
    case), idempotent load, step-9 KPIs of the loaded table.  Returns
    (validation, KPIs)."""
    (table,) = _tables(prefix, "ventes_testable")
    report = Q.validate_testable(sales, allowed)
    t = En.transform_testable(_gate(sales, report, gate, grouped), edges=edges)
    _load(spark, t, table, "date string, produit string, vendeur string, quantite int, "
                           "montant decimal(18,2), marge decimal(18,2), taux_marge double, "
                           "taille_vente string", days, grouped)
    return report, K.kpis_basic(spark.table(table))


def final_etl(spark: SparkSession, raw: DataFrame | str, objectif: float = 50000, min_lignes: int = 10,
              edges: Sequence[float] = DEFAULT_EDGES, n_latest: int = 10,
              stages: DataFrame | None = None, targets: DataFrame | None = None,
              source: str = "SOURCE_PRINCIPALE", prefix: str | None = None, days: Days = None,
              gate: str = "quarantine") -> dict[str, DataFrame]:
    """Read (a frame, or a CSV folder), raw load, validation gate,
    strategy label, enrichment, idempotent clean load, final KPIs with the
    run's total duration (``stages``: date, stage, seconds), keyed upsert,
    the ``n_latest`` latest days, the slow-run check over the history, and
    the regions against their daily ``targets``.

    Returns ``validation``, ``strategy``, ``kpis``, ``latest``, ``slow`` and,
    with targets, ``regions``."""
    raw_t, clean_t, kpi_t = _tables(prefix, "ventes_raw", "ventes_clean", "kpis_journaliers")
    cols = [c for c in _ddl_cols(VENTES_DDL) if c != "charge_le"]
    if isinstance(raw, str):
        raw = read_csv(spark, raw, VENTES_DDL.rsplit(", ", 1)[0])
    loaded = _load(spark, En.with_lineage(raw), raw_t, VENTES_DDL, days)  # read once, judged from the table
    report = Q.validate_final(loaded.select(*cols), min_lignes)
    accepted = _gate(loaded, report, gate)
    strategy = Ro.choose_strategy(accepted, objectif)
    clean = _load(spark, En.with_const(En.enrich_final(accepted, edges=edges), source=source),
                  clean_t, FINAL_DDL, days)
    k = K.kpis_final(clean, objectif)
    empty = spark.createDataFrame([], "date string, stage string, seconds double")
    lasted = M.run_metrics(empty if stages is None else stages).select("date", "duree_totale_s")
    k = k.join(lasted, "date", "left").withColumn(
        "duree_totale_s", F.coalesce("duree_totale_s", F.lit(0.0)))
    ensure_table(spark, kpi_t, "date string, ca_total double, marge_totale double, "
                               "taux_marge double, nb_ventes bigint, panier_moyen double, "
                               "top_produit string, top_vendeur string, atteinte_obj double, "
                               "statut string, duree_totale_s double", partition=MONTH)
    upsert_kpis(spark, k, kpi_t, days=days)
    kpis = rows_of(spark, kpi_t)
    out = {"validation": report, "strategy": strategy, "kpis": kpis,
           "latest": Rp.latest_days(kpis, n_latest), "slow": M.perf_anomaly(kpis, n=10)}
    if targets is not None:
        out["regions"] = Rp.region_daily_attainment(spark.table(clean_t), targets)
    return out


def day_routing(spark: SparkSession, sales: DataFrame, out: str, limits=Ro.ROUTE_LIMITS
                ) -> DataFrame:
    """Day totals -> route label; each day's rows are written under
    their route; returns rows per route read back from the output."""
    routes = Ro.classify_day(sales, limits)
    Ro.split_by(sales.select("date", "montant"), routes, out)
    back = spark.read.parquet(out)
    return back.groupBy("traitement").agg(F.count(F.lit(1)).alias("nb_lignes"),
                                          F.countDistinct("date").alias("nb_jours"))


def file_check(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read a file and summarise it per date (rows, CA, valid)."""
    return Q.load_summary(read_csv(spark, path, schema))
