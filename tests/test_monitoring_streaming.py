"""Run metrics, history anomalies, time limits, and stream = batch."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesflow.operators import monitoring as M
from salesflow.session import scratch_path, unique_table


def metrics_fixture(spark):
    """12 days: day 8 slow (> 1.5x mean), day 10 low volume (< 0.7x)."""
    rows = []
    for i in range(1, 13):
        dur = 300.0 if i == 8 else 100.0
        vol = 10 if i == 10 else 30
        rows.append((f"2024-01-{i:02d}", vol, dur))
    return spark.createDataFrame(rows, "date string, nb_lignes bigint, duree_totale_s double")


def test_perf_and_volume_anomalies(spark):
    m = metrics_fixture(spark)
    perf = {r.date: (r.anomalie_perf, r.nb_jours_historique) for r in M.perf_anomaly(m).collect()}
    assert perf["2024-01-08"] == (True, 7)
    assert perf["2024-01-01"] == (False, 1) and perf["2024-01-02"] == (False, 2)
    assert sum(a for a, _ in perf.values()) == 1
    vol = {r.date: r.baisse_volume for r in M.volume_anomaly(m).collect()}
    assert vol["2024-01-10"] is True and sum(vol.values()) == 1


def test_history_check_needs_minimum_days(spark):
    m = spark.createDataFrame([("d1", 1, 10.0), ("d2", 1, 100.0)],
                              "date string, nb_lignes bigint, duree_totale_s double")
    assert not any(r.anomalie_perf for r in M.perf_anomaly(m).collect())


def test_literal_latest_window(spark):
    m = metrics_fixture(spark)
    r = M.latest_window_check(m, 7, 1.5, 3, "duree_totale_s", current=300.0).first()
    # the 7 latest rows (06..12) include the slow day: mean 128.5714, 300 > 1.5 x mean
    assert (r.nb_jours, r.moyenne, r.anomalie) == (7, 128.5714, True)


def test_run_metrics_and_sla(spark):
    stages = spark.createDataFrame([("d", "extract", 400.0), ("d", "transform", 10.0)],
                                   "date string, stage string, seconds double")
    sales = spark.createDataFrame([("d", Decimal("10.00")), ("d", Decimal("5.55"))],
                                  "date string, montant decimal(18,2)")
    m = M.run_metrics(stages, sales).first()
    assert (m.duree_extract_s, m.duree_transform_s, m.duree_load_s, m.duree_totale_s) == \
        (400.0, 10.0, 0.0, 410.0)
    assert (m.nb_lignes, m.ca_total, m.taux_erreur, m.statut) == (2, 15.55, 0.0, "SUCCES")
    br = M.sla_breaches(M.run_metrics(stages, sales)).collect()
    assert [(r.etape, r.limite_s) for r in br] == [("extract", 300.0)]


def test_stream_equals_batch(spark, tmp_path):
    from salesflow.streaming import daily_kpi_stream, event_counts_stream, file_stream
    ev = spark.createDataFrame(
        [(i, f"2024-01-0{1 + i % 3} 10:00:00", "click" if i % 2 else "view", float(i))
         for i in range(30)], "event_id long, ts string, event_type string, value double") \
        .withColumn("ts", F.to_timestamp_ntz("ts"))
    src = str(tmp_path / "events")
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):  # days arrive in order
        ev.where(F.date_format("ts", "yyyy-MM-dd") == day).coalesce(1).write.mode("append").parquet(src)
    stream = file_stream(spark, src, ev.schema, max_files_per_trigger=1)
    out = daily_kpi_stream(spark, stream, unique_table("s"), scratch_path(spark, "ck"))
    batch = ev.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("date")).agg(
        F.count(F.lit(1)).alias("nb_evenements"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("valeur_totale"))
    assert sorted(tuple(r) for r in out.collect()) == sorted(tuple(r) for r in batch.collect())
    counts = event_counts_stream(spark, file_stream(spark, src, ev.schema), unique_table("c"),
                                 scratch_path(spark, "ck2"))
    assert counts.agg(F.sum("nb")).first()[0] == 30


def test_arrivals_once(spark, tmp_path):
    from salesflow.streaming import ingest_arrivals
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "export_2024-01-01.csv").write_text("vendeur,ca\nAlice,1\nKarim,2\n")
    target, ck = scratch_path(spark, "t"), scratch_path(spark, "ck")
    assert ingest_arrivals(spark, str(inbox), "vendeur string, ca int", target, ck).count() == 2
    (inbox / "export_2024-01-02.csv").write_text("vendeur,ca\nLucie,3\n")
    got = ingest_arrivals(spark, str(inbox), "vendeur string, ca int", target, ck)
    assert got.count() == 3  # the first file is not taken twice



def test_sync_inbox_exports_are_not_written_by_one_task(spark, monkeypatch):
    import glob
    from salesflow.registry import q_streams

    class Delivered(Exception):
        pass

    def first_sync(spark, inbox, *_):
        raise Delivered(inbox)
    monkeypatch.setattr(q_streams, "sync_inbox", first_sync)
    small = "spark.sql.adaptive.coalescePartitions.enabled"  # else small regions share a task
    spark.conf.set(small, "false")
    try:
        with pytest.raises(Delivered) as e:
            q_streams.l1_sync_inbox(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.unset(small)
    names = glob.glob(f"{str(e.value).removeprefix('file:')}/region=*/part-*.csv")
    tasks = {n.split("/part-")[1].split("-")[0] for n in names}
    assert len({n.split("/")[-2] for n in names}) == 4 and len(tasks) > 1
