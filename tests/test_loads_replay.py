"""Replays, late files, real CSV files and gates that stop."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesflow.operators.quality import InvalidDays
from salesflow.plans import jobs as J
from salesflow.session import scratch_path, unique_table
from salesflow.sinks import (MONTH, append_by_name, append_with_ids, ensure_table, replace_day, replace_days,
                             rows_of, upsert_kpis, write_csv)
from salesflow.sources import read_available, read_csv, read_many, unreadable_files
from salesflow.streaming import inbox_changes, ingest_arrivals, sync_inbox

DDL = "date string, vendeur string, montant decimal(18,2)"
FULL = "date string, produit string, categorie string, vendeur string, region string, quantite int, montant decimal(18,2)"


def sales(spark, rows):
    return spark.createDataFrame([(d, v, Decimal(str(m))) for d, v, m in rows], DDL)


def full(spark, rows):
    return spark.createDataFrame([(d, "P", "C", v, "R", 1, Decimal(str(m))) for d, v, m in rows], FULL)


def state(spark, t, *cols):
    return sorted(tuple(r) for r in rows_of(spark, t).select(*(cols or ("date", "vendeur"))).collect())


def test_cleared_day_does_not_come_back(spark):
    t = unique_table("clear")
    ensure_table(spark, t, DDL)
    replace_days(spark, sales(spark, [("2024-01-01", "OLD", 1), ("2024-01-02", "OLD", 2)]), t)
    replace_days(spark, sales(spark, []), t, days=["2024-01-02"])
    append_by_name(spark, sales(spark, [("2024-01-02", "NEW", 3)]), t)
    assert state(spark, t) == [("2024-01-01", "OLD"), ("2024-01-02", "NEW")]


@pytest.mark.parametrize("bad", ["2024-01-01' OR '1'='1", "today", "2024-13-01"])
def test_day_must_be_a_date(spark, bad):
    t = unique_table("day")
    ensure_table(spark, t, DDL)
    with pytest.raises(ValueError):
        replace_day(spark, sales(spark, []), t, bad)
    with pytest.raises(ValueError):
        ensure_table(spark, "t; DROP TABLE x", DDL)


def test_upsert_removes_a_day_that_became_empty(spark):
    t = unique_table("kpi")
    ensure_table(spark, t, "date string, ca double", partition=MONTH)
    k = "date string, ca double"
    upsert_kpis(spark, spark.createDataFrame([("2024-01-01", 1.0), ("2024-02-01", 2.0), ("2024-02-02", 3.0)], k), t)
    upsert_kpis(spark, spark.createDataFrame([], k), t, days=["2024-01-01", "2024-02-02"])
    assert state(spark, t, "date", "ca") == [("2024-02-01", 2.0)]
    ensure_table(spark, flat := unique_table("flat"), k, partition=None)
    with pytest.raises(ValueError, match="by month"):
        upsert_kpis(spark, spark.createDataFrame([("2024-01-01", 1.0)], k), flat)


def test_ids_are_not_reused_after_a_delete(spark):
    t, marks = unique_table("ids"), unique_table("marks")
    ensure_table(spark, t, "id bigint, date string, vendeur string, montant decimal(18,2)")
    append_with_ids(spark, sales(spark, [("2024-01-01", "A", 1), ("2024-01-02", "B", 2), ("2024-01-03", "C", 3)]), t, ["date"], marks)
    replace_days(spark, spark.table(t).limit(0), t, days=["2024-01-03"])
    append_with_ids(spark, sales(spark, [("2024-01-04", "D", 4)]), t, ["date"], marks)
    append_with_ids(spark, sales(spark, []), t, ["date"], marks)
    assert state(spark, t, "id", "vendeur") == [(1, "A"), (2, "B"), (4, "D")]


def test_csv_goes_by_the_header(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text('vendeur,date,montant,autre\n"TV 55"" x, y",2024-01-01,12.5,z\nAlice,2024-01-01,12x,z\nBob,2024-01-01,NA,z\n')
    df = read_csv(spark, str(p), DDL, bad_cells=True)
    assert [tuple(r) for r in df.collect()] == [("2024-01-01", 'TV 55" x, y', Decimal("12.50"), 0),
                                                ("2024-01-01", "Alice", None, 1), ("2024-01-01", "Bob", None, 0)]
    with pytest.raises(ValueError, match="absent from the header"):
        read_csv(spark, str(p), DDL + ", region string")
    out = write_csv(df.select("vendeur"), str(tmp_path / "out"))
    assert read_csv(spark, out, "vendeur string").first()[0] == 'TV 55" x, y'
    (tmp_path / "y.csv").write_text("date,vendeur,montant,autre\n2024-01-01,Eve,1,z\n")
    with pytest.raises(Exception):  # headers that differ are an error, not a shift of columns
        read_csv(spark, [str(p), str(tmp_path / "y.csv")], DDL).collect()


def test_late_files_are_ingested(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    head = "date,vendeur,montant\n"
    (inbox / "a.csv").write_text(head + "2024-02-01,A,1\n")
    args = (spark, str(inbox), DDL, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    ingest_arrivals(*args)
    (inbox / "b.csv").write_text(head + "2024-01-01,B,2\n")
    old = os.stat(inbox / "a.csv").st_mtime - 30 * 86400
    os.utime(inbox / "b.csv", (old, old))
    assert sorted(r.vendeur for r in ingest_arrivals(*args).collect()) == ["A", "B"]


def test_corrected_file_replaces_its_rows_and_days(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    head = "date,vendeur,montant\n"
    (inbox / "a.csv").write_text(head + "2024-01-01,A,1\n2024-01-02,A,5\n")
    (inbox / "b.csv").write_text(head + "2024-01-01,B,2\n")
    raw, seen, daily = (unique_table(x) for x in ("raw", "seen", "daily"))
    ensure_table(spark, daily, "date string, ca double")

    def sync():
        return sync_inbox(spark, str(inbox), DDL, raw, seen, daily,
                          lambda rows: rows.groupBy("date").agg(F.sum("montant").cast("double").alias("ca"))).count()
    assert sync() == 2 and sync() == 0
    assert state(spark, daily, "date", "ca") == [("2024-01-01", 3.0), ("2024-01-02", 5.0)]
    (inbox / "a.csv").write_text(head + "2024-01-01,A,10\n")
    assert sync() == 2
    assert state(spark, daily, "date", "ca") == [("2024-01-01", 12.0)]


def day_sums(rows):
    return rows.groupBy("date").agg(F.sum("montant").cast("double").alias("ca"))


def inbox_tables(spark):
    raw, seen, daily = (unique_table(x) for x in ("raw", "seen", "daily"))
    ensure_table(spark, daily, "date string, ca double")
    return raw, seen, daily


def test_inbox_change_sets(spark, tmp_path):
    """Emptied, withdrawn, returned, reordered files; tombstones."""
    inbox = tmp_path / "it's in"
    inbox.mkdir()
    head = "date,vendeur,montant\n"
    for name, text in (("a.csv", "2024-01-01,A,1\n2024-01-02,A,5\n"), ("b'.csv", "2024-01-01,B,2\n"), ("c.csv", "2024-01-03,C,7\n")):
        (inbox / name).write_text(head + text)
    raw, seen, daily = inbox_tables(spark)

    def changes():
        return sorted((os.path.basename(r.fichier), r.etat) for r in inbox_changes(spark, str(inbox), seen).collect())

    def sync():
        return sorted(r.date for r in sync_inbox(spark, str(inbox), DDL, raw, seen, daily, day_sums).collect())
    assert sync() == ["2024-01-01", "2024-01-02", "2024-01-03"] and changes() == []
    (inbox / "a.csv").write_text(head)  # corrected to no rows
    (inbox / "c.csv").unlink()  # withdrawn
    (inbox / "d.csv").write_text("montant,extra,vendeur,date\n4,x,D,2024-01-01\n")  # another order, a column more
    (inbox / "e.csv").write_text(head + "2024-01-09,E,9\n")
    assert changes() == [("a.csv", "modifie"), ("c.csv", "retire"), ("d.csv", "nouveau"), ("e.csv", "nouveau")]
    assert sync() == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-09"]
    assert state(spark, daily, "date", "ca") == [("2024-01-01", 6.0), ("2024-01-09", 9.0)]
    assert sorted({os.path.basename(r.fichier) for r in spark.table(raw).collect()}) == ["b'.csv", "d.csv", "e.csv"]
    assert changes() == [] and sync() == []  # the tombstone is reported once
    (inbox / "b'.csv").write_text(head)
    (inbox / "c.csv").write_text(head + "2024-01-03,C,8\n")  # comes back
    assert changes() == [("b'.csv", "modifie"), ("c.csv", "nouveau")]
    assert sync() == ["2024-01-01", "2024-01-03"]
    assert state(spark, daily, "date", "ca") == [("2024-01-01", 4.0), ("2024-01-03", 8.0), ("2024-01-09", 9.0)]


def test_inbox_sync_survives_a_crash(spark, tmp_path):
    """The run ends after the raw rows are gone: their days are rebuilt by the
    next sync, from the note."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.csv").write_text("date,vendeur,montant\n2024-01-01,A,1\n2024-01-02,A,5\n")
    raw, seen, daily = inbox_tables(spark)
    sync_inbox(spark, str(inbox), DDL, raw, seen, daily, day_sums)
    (inbox / "a.csv").unlink()
    (inbox / "b.csv").write_text("date,vendeur,montant\n2024-01-02,B,3\n")

    def broken(rows):
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError):
        sync_inbox(spark, str(inbox), DDL, raw, seen, daily, broken)
    assert state(spark, daily, "date", "ca") == [("2024-01-01", 1.0), ("2024-01-02", 5.0)]
    assert sync_inbox(spark, str(inbox), DDL, raw, seen, daily, day_sums).count() == 2
    assert state(spark, daily, "date", "ca") == [("2024-01-02", 3.0)]
    assert sync_inbox(spark, str(inbox), DDL, raw, seen, daily, day_sums).isEmpty()


def test_files_by_their_own_headers(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.csv").write_text("date,vendeur,montant\n2024-01-01,A,1\n\n2024-01-02,NA,x\n")
    (inbox / "b.csv").write_text('montant,note,date,vendeur\r\n2,"n, ""q""",2024-01-01,"B, C"\r\n3,short\r\n')
    (inbox / "c.csv").write_text("\ufeffvendeur,montant,date\n")
    got = sorted((r.date or "", r.vendeur or "", r.montant, os.path.basename(r._file)) for r in read_many(spark, str(inbox), DDL).collect())
    assert got == [("", "", Decimal("3.00"), "b.csv"), ("2024-01-01", "A", Decimal("1.00"), "a.csv"),
                   ("2024-01-01", "B, C", Decimal("2.00"), "b.csv"), ("2024-01-02", "", None, "a.csv")]
    (inbox / "d.csv").write_text("vendeur,montant\nD,1\n")
    with pytest.raises(Exception, match="columns absent"):
        read_many(spark, str(inbox), DDL).collect()
    paths = [str(inbox / f"{x}.csv") for x in "abcdz"]
    assert sorted(os.path.basename(r._file) for r in read_available(spark, paths, DDL).collect()) == ["a.csv", "a.csv", "b.csv", "b.csv"]
    assert sorted((os.path.basename(r.fichier), r.motif) for r in unreadable_files(spark, paths, DDL).collect()) == [
        ("d.csv", "colonnes"), ("z.csv", "absent")]


def test_only_unreadable_files(spark, tmp_path):
    (tmp_path / "x.csv").write_text("")
    (tmp_path / "y.csv.gz").write_bytes(b"\x1f\x8b\x08no archive")
    paths = [str(tmp_path / "x.csv"), str(tmp_path / "y.csv.gz")]
    assert read_available(spark, paths, DDL).isEmpty()
    assert sorted(r.motif for r in unreadable_files(spark, paths, DDL).collect()) == ["illisible", "vide"]


def test_multi_source_replay_drops_stale_sellers(spark, tmp_path):
    prefix, schema = unique_table("ms"), "date string, region string, ca_region decimal(18,2), nb_ventes bigint, source string"
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "region_idf_2024-01-01.csv").write_text("date,region,ca_region,nb_ventes,source\n2024-01-01,idf,7,1,F\n")

    def api(*rows):
        return spark.createDataFrame([("2024-01-01", v, "P", Decimal(m), "API") for v, m in rows],
                                     "date string, vendeur string, produit string, montant decimal(18,2), source string")
    for rows in ((("Alice", 10), ("Karim", 20)), (("Alice", 10),)):
        view, total = J.multi_source(spark, api(*rows), str(inbox), schema, prefix=prefix, days=["2024-01-01"],
                                     file_suffix="2024-01-01.csv")
    assert total.first().ca_total == 10.0
    assert sorted((r.dimension, r.valeur) for r in view.collect()) == [("region", "idf"), ("vendeur", "Alice")]
    assert read_many(spark, str(inbox), schema, prefix="none_") is None


@pytest.mark.parametrize("job", ["daily", "testable", "final", "monitored"])
def test_gates_stop(spark, job):
    bad = full(spark, [("2024-01-01", "Alice", -1)])
    ok = spark.createDataFrame([("Alice",)], "vendeur string")
    stages = spark.createDataFrame([("2024-01-01", "extract", 1.0)], "date string, stage string, seconds double")
    with pytest.raises(InvalidDays) as e:
        {"daily": lambda: J.daily_flow(spark, bad, ok, scratch_path(spark, "g"), gate="stop"),
         "testable": lambda: J.testable_etl(spark, bad, ok, gate="stop"),
         "final": lambda: J.final_etl(spark, bad, gate="stop"),
         "monitored": lambda: J.monitored_etl(spark, bad, ok, stages, gate="stop")}[job]()
    assert e.value.count == 1


def test_final_etl_from_csv_over_two_days(spark):
    prefix = unique_table("fin")
    for day, rows in (("2024-01-01", [("2024-01-01", "Alice", 600)] * 3), ("2024-01-02", [("2024-01-02", "Karim", 100)] * 3),
                      ("2024-01-02", [])):
        path = write_csv(full(spark, rows), scratch_path(spark, "raw"))
        stages = spark.createDataFrame([(day, "extract", 2.0), (day, "load", 1.5)], "date string, stage string, seconds double")
        out = J.final_etl(spark, path, objectif=1000, min_lignes=2, stages=stages, prefix=prefix, days=[day])
        if rows and day == "2024-01-02":
            assert sorted(r.date for r in out["kpis"].collect()) == ["2024-01-01", "2024-01-02"]
    assert [(r.date, r.ca_total, r.duree_totale_s, r.statut) for r in out["kpis"].collect()] == [("2024-01-01", 1800.0, 3.5, "excellent")]
    clean = spark.table(f"{prefix}_ventes_clean")
    assert {"categorie", "region", "quantite", "source"} <= set(clean.columns) and clean.count() == 3
