"""Streaming queries, checked against batch SQL."""

from salesflow.operators import kpis as K
from salesflow.registry import register
from salesflow.registry._sql import W
from salesflow.registry.q_sources import drop_folder, put_file
from salesflow.session import scratch_path, unique_table
from salesflow.sinks import ensure_table, write_csv
from salesflow.streaming import (daily_kpi_stream, event_counts_stream, event_log_stream, file_stream,
                                 ingest_arrivals, late_events, sync_inbox, whole_events_stream)
from salesflow.views import table, ventes

ARRIVAL_SCHEMA = "date string, vendeur string, montant decimal(18,2), l_orderkey bigint"


@register("l1_ingest_arrivals", W + """
SELECT date, CAST(sum(montant) AS DOUBLE) AS ca_total, count(*) AS nb_ventes FROM ventes GROUP BY date""")
def l1_ingest_arrivals(spark, sf_dir):
    """Sales files dropped in an inbox are ingested as they arrive (a few
    files per micro-batch); a second run with the same checkpoint finds
    nothing new.  The days touched are then rebuilt from what arrived."""
    inbox = scratch_path(spark, "inbox")
    write_csv(ventes(spark, sf_dir).select("date", "vendeur", "montant", "l_orderkey"), inbox)
    target, ckpt = scratch_path(spark, "arrivals"), scratch_path(spark, "arrivals-ckpt")
    ingest_arrivals(spark, inbox, ARRIVAL_SCHEMA, target, ckpt, file_glob="*.csv",
                    max_files_per_trigger=2)
    got = ingest_arrivals(spark, inbox, ARRIVAL_SCHEMA, target, ckpt, file_glob="*.csv")
    return K.day_totals(got)


def _events_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return file_stream(spark, sf_dir.rstrip("/"), schema, glob="events.parquet")


@register("l2_daily_kpi_stream", """
SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS nb_evenements,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS valeur_totale
FROM events GROUP BY 1""")
def l2_daily_kpi_stream(spark, sf_dir):
    return daily_kpi_stream(spark, _events_stream(spark, sf_dir), unique_table("kpi_stream"),
                            scratch_path(spark, "l2-ckpt"))


@register("l3_event_counts", """
SELECT strftime(ts, '%Y-%m-%d') AS date, event_type AS type_event, count(*) AS nb
FROM events GROUP BY 1, 2""")
def l3_event_counts(spark, sf_dir):
    return event_counts_stream(spark, _events_stream(spark, sf_dir), unique_table("event_counts"),
                               scratch_path(spark, "l3-ckpt"))


@register("l1_sync_inbox", W + """
SELECT date, CAST(sum(montant) AS DOUBLE) AS ca_total, count(*) AS nb_ventes FROM ventes
WHERE region <> 'ASIA' OR l_linenumber = 1 GROUP BY date""")
def l1_sync_inbox(spark, sf_dir):
    """An export per region (a large one in several files), one of them late: only the days that it
    touches are rebuilt, from the rows of all files."""
    inbox, raw, seen, daily = scratch_path(spark, "sync"), *(unique_table(x) for x in ("raw", "seen", "daily"))
    v = ventes(spark, sf_dir).select("date", "vendeur", "montant", "region", "l_linenumber")
    ensure_table(spark, daily, "date string, ca_total double, nb_ventes bigint")
    schema = "date string, vendeur string, montant decimal(18,2), l_linenumber int"

    def deliver(rows):
        rows.hint("rebalance", "region").write.mode("append").partitionBy("region").option("header", True).csv(inbox)

    def sync():
        return sync_inbox(spark, inbox, schema, raw, seen, daily, K.day_totals)
    deliver(v.where("region <> 'ASIA'"))
    sync()
    deliver(v.where("region = 'ASIA' and l_linenumber = 1"))
    sync()
    sync()
    return spark.table(daily).select("date", "ca_total", "nb_ventes")


@register("l1_change_set", W + """
SELECT date, CAST(sum(montant) AS DOUBLE) AS ca_total, count(*) AS nb_ventes FROM ventes
WHERE region NOT IN ('ASIA', 'EUROPE') GROUP BY date""")
def l1_change_set(spark, sf_dir):
    """An inbox whose exports change: one is corrected to its header alone, one
    is withdrawn, a late one has its columns in another order.  The daily table
    is that of the files that are left."""
    inbox, raw, seen, daily = scratch_path(spark, "changes"), *(unique_table(x) for x in ("raw", "seen", "daily"))
    v = ventes(spark, sf_dir).select("date", "vendeur", "montant", "region")
    ensure_table(spark, daily, "date string, ca_total double, nb_ventes bigint")

    def deliver(rows, mode="append"):
        rows.hint("rebalance", "region").write.mode(mode).partitionBy("region").option("header", True).csv(inbox)

    def sync():
        return sync_inbox(spark, inbox, "date string, vendeur string, montant decimal(18,2)", raw, seen, daily, K.day_totals)
    deliver(v.where("region not in ('ASIA', 'AFRICA')"))
    put_file(spark, f"{inbox}/region=ASIA/export.csv", b"date,vendeur,montant\n1995-01-01,avant,1.00\n1900-01-01,avant,2.00\n")
    sync()
    put_file(spark, f"{inbox}/region=ASIA/export.csv", b"date,vendeur,montant\n")  # corrected to no rows
    drop_folder(spark, f"{inbox}/region=EUROPE")  # withdrawn
    deliver(v.where("region = 'AFRICA'").select("montant", "region", "date", "vendeur"))  # late, in another order
    sync()
    return spark.table(daily).select("date", "ca_total", "nb_ventes")


@register("l3_event_log", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, event_type, value FROM events""")
def l3_event_log(spark, sf_dir):
    """The event log as an append stream; a second run adds nothing."""
    target, ckpt = scratch_path(spark, "log"), scratch_path(spark, "log-ckpt")
    event_log_stream(spark, _events_stream(spark, sf_dir), target, ckpt)
    log = event_log_stream(spark, _events_stream(spark, sf_dir), target, ckpt)
    return log.select("event_id", "date", "event_type", "value")


# the second delivery: events of one type, and those of another once more
_SECOND, _TWICE = "event_type = 'purchase'", "event_type = 'view'"


def _late_stream(spark, sf_dir):
    """Events in two deliveries, the second out of order and with repeats."""
    events = table(spark, sf_dir, "events")
    inbox, folder, days = scratch_path(spark, "late-in"), scratch_path(spark, "late"), unique_table("days")

    def take():
        whole_events_stream(spark, file_stream(spark, inbox, events.schema), folder, days)
    events.where(f"not ({_SECOND})").write.mode("append").parquet(inbox)
    take()
    events.where(f"{_SECOND} or {_TWICE}").unionByName(events.where(_SECOND)).write.mode("append").parquet(inbox)
    take()
    take()
    return folder, days, events.schema


_LATE_SQL = f"""
w AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY AS mark FROM events WHERE NOT ({_SECOND})),
e AS (SELECT events.*, strftime(ts, '%Y-%m-%d') AS date, {_SECOND} AND ts <= mark AS late FROM events, w)"""


@register("l2_whole_days", f"""WITH {_LATE_SQL}
SELECT date, count(*) AS nb_evenements, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS valeur_totale,
       count(*) FILTER (WHERE late) AS nb_tardifs FROM e GROUP BY date""")
def l2_whole_days(spark, sf_dir):
    """Days of a stream with late and repeated events: equal to the batch."""
    _, days, _ = _late_stream(spark, sf_dir)
    return spark.table(days).select("date", "nb_evenements", "valeur_totale", "nb_tardifs")


@register("l3_late_events", f"""WITH {_LATE_SQL}
SELECT event_id, date, event_type, value FROM e WHERE late""")
def l3_late_events(spark, sf_dir):
    """The side table of events behind the watermark, each once."""
    folder, _, schema = _late_stream(spark, sf_dir)
    return late_events(spark, schema, folder).select("event_id", "date", "event_type", "value")
