"""Run metrics, history anomalies and time-limit breaches.

The history checks run on the daily metrics table (one row per date and
series), never on raw rows: the window is bounded by the calendar.  A
``series`` key (e.g. a pipeline or stage name) spreads the frames over
tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesflow.functions.numeric import MONEY, ratio
from salesflow.operators._common import By, by_list

# Fixed values from the reference: stage names, status, time limits (s).
STAGES = ("extract", "transform", "load")
STATUS_OK = "SUCCES"
STATUS_FAILED = "ECHEC"
DEFAULT_LIMITS = {"extract": 300, "task": 600, "run": 1800}


def run_metrics(stages: DataFrame, sales: DataFrame | None = None, key: str = "date",
                errors: DataFrame | None = None, rejected: DataFrame | None = None) -> DataFrame:
    """One metrics row per date.

    ``stages``: (date, stage, seconds); stage durations are pivoted on
    the known stage names (missing -> 0), total = their sum rounded to 2.
    ``sales``: (date, montant) -> nb_lignes and ca_total.  ``errors``:
    (date, nb_erreurs) -> taux_erreur = errors / rows; 0.0 when unknown.
    ``rejected``: (date) of the days that loaded nothing; their ``statut`` is
    ``ECHEC``, that of the others ``SUCCES``.
    """
    wide = (stages.groupBy(key).pivot("stage", list(STAGES))
            .agg(F.sum(F.col("seconds").cast("decimal(18,2)"))))
    durs = [F.coalesce(F.col(s), F.lit(0).cast("decimal(18,2)")) for s in STAGES]
    out = wide.select(key, *[d.cast("double").alias(f"duree_{s}_s") for d, s in zip(durs, STAGES)],
                      F.round(durs[0] + durs[1] + durs[2], 2).cast("double").alias("duree_totale_s"))
    if sales is not None:
        vol = sales.groupBy(key).agg(
            F.count(F.lit(1)).alias("nb_lignes"),
            F.round(F.sum(F.col("montant").cast(MONEY)), 2).cast("double").alias("ca_total"))
        # a day with sales and no stage rows has durations 0, and the reverse
        out = out.join(vol, key, "full").withColumns(
            {c: F.coalesce(F.col(c), F.lit(0.0)) for c in out.columns if c != key}).withColumn(
            "nb_lignes", F.coalesce(F.col("nb_lignes"), F.lit(0)))
    if errors is not None and sales is not None:
        out = out.join(errors, key, "left").withColumn(
            "taux_erreur",
            F.when(F.col("nb_lignes") > 0,
                   ratio(F.coalesce(F.col("nb_erreurs"), F.lit(0)), F.col("nb_lignes"), 4,
                         half_even=False)).otherwise(F.lit(0.0))
        ).drop("nb_erreurs")
    else:
        out = out.withColumn("taux_erreur", F.lit(0.0))
    if rejected is None:
        return out.withColumn("statut", F.lit(STATUS_OK))
    failed = rejected.select(key).distinct().withColumn("_failed", F.lit(True))
    out = out.join(failed, key, "full").withColumns(
        {c: F.coalesce(c, F.lit(0).cast(t)) for c, t in out.dtypes if c != key})
    return out.withColumn("statut", F.when(F.col("_failed"), STATUS_FAILED).otherwise(STATUS_OK)).drop("_failed")


def history_mean(metrics: DataFrame, duration: str = "duree_totale_s",
                 volume: str = "nb_lignes") -> DataFrame:
    """Mean duration and mean volume over the metrics history."""
    return metrics.agg(
        ratio(F.sum(F.col(duration).cast("decimal(18,2)")), F.count(F.lit(1)), 2).alias("duree_moyenne_s"),
        ratio(F.sum(volume), F.count(F.lit(1)), 2).alias("volume_moyen"))


def _history_window(series: By, key: str, n: int):
    keys = by_list(series)
    w = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return w.orderBy(key).rowsBetween(-(n - 1), 0)


def perf_anomaly(metrics: DataFrame, n: int = 7, k: float = 1.5, min_days: int = 3,
                 value: str = "duree_totale_s", key: str = "date",
                 series: By = None) -> DataFrame:
    """H1/H3: for every date, the mean of ``value`` over the ``n`` latest
    rows up to it (itself included); anomaly when at least ``min_days``
    rows and ``value > k * mean``."""
    return _rolling_flag(metrics, n, k, min_days, value, key, series, above=True,
                         name="anomalie_perf")


def volume_anomaly(metrics: DataFrame, n: int = 7, k: float = 0.7, min_days: int = 2,
                   value: str = "nb_lignes", key: str = "date",
                   series: By = None) -> DataFrame:
    """H2: volume drop: at least ``min_days`` rows and ``value < k * mean``."""
    return _rolling_flag(metrics, n, k, min_days, value, key, series, above=False,
                         name="baisse_volume")


def _rolling_flag(metrics, n, k, min_days, value, key, series, above, name):
    w = _history_window(series, key, n)
    v = F.col(value).cast("decimal(18,2)")
    total, cnt = F.sum(v).over(w), F.count(F.lit(1)).over(w)
    known = F.count(v).over(w)
    ours, limit = v * known, total * F.lit(Decimal(str(k)))  # v against k * mean, undivided
    hit = (ours > limit) if above else (ours < limit)
    return metrics.select(*by_list(series), key, F.col(value),
                          ratio(total, known, 4, half_even=False).alias(f"moyenne_{value}"),
                          cnt.alias("nb_jours_historique"),
                          ((cnt >= min_days) & hit).alias(name))


def latest_window_check(metrics: DataFrame, n: int, k: float, min_days: int,
                        value: str, current: float, key: str = "date",
                        above: bool = True) -> DataFrame:
    """H1 literal form: compare ``current`` with the mean of the ``n``
    latest rows of the table (any date, as the reference reads them)."""
    latest = metrics.orderBy(F.desc(key)).limit(n)
    s = latest.agg(F.sum(F.col(value).cast("decimal(18,2)")).alias("t"), F.count(value).alias("n"),
                   F.count(F.lit(1)).alias("c"))
    cur = F.lit(Decimal(str(current))) * F.col("n")
    lim = F.col("t") * F.lit(Decimal(str(k)))
    hit = (cur > lim) if above else (cur < lim)
    return s.select(ratio("t", "n", 4, half_even=False).alias("moyenne"), F.col("c").alias("nb_jours"),
                    ((F.col("c") >= min_days) & hit).alias("anomalie"))


def sla_breaches(metrics: DataFrame, limits: dict | None = None, key: str = "date",
                 stages: Sequence[str] = STAGES) -> DataFrame:
    """H4: unpivot stage durations and keep those above their limit:
    the extract limit for ``extract``, the per-task limit for every stage,
    the run limit for the total."""
    lim = dict(DEFAULT_LIMITS if limits is None else limits)
    cols = [f"duree_{s}_s" for s in stages] + ["duree_totale_s"]
    names = list(stages) + ["run"]
    long = metrics.select(key, F.explode(F.array(*[
        F.struct(F.lit(nm).alias("etape"), F.col(c).alias("duree_s"))
        for nm, c in zip(names, cols)])).alias("x")).select(key, "x.etape", "x.duree_s")
    limit = F.lit(float(lim["task"]))
    for s in stages:
        if s in lim:
            limit = F.when(F.col("etape") == s, F.least(F.lit(float(lim[s])), F.lit(float(lim["task"])))) \
                     .otherwise(limit)
    limit = F.when(F.col("etape") == "run", F.lit(float(lim["run"]))).otherwise(limit)
    return long.withColumn("limite_s", limit).where(F.col("duree_s") > F.col("limite_s"))
