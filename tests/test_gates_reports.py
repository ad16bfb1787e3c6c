"""Gate, quarantine, reconciliation, exports and configuration parsing."""

from decimal import Decimal

import pytest

from salesflow.operators import quality as Q
from salesflow.session import scratch_path
from salesflow.sinks import export_report
from salesflow.sources import read_csv
from salesflow.sources.config import parse_config

S = "date string, produit string, vendeur string, montant decimal(18,2)"


def sales(spark, rows):
    return spark.createDataFrame([(d, p, v, None if m is None else Decimal(str(m)))
                                  for d, p, v, m in rows], S)


def test_gate_raises_with_joined_messages(spark, allowed):
    df = sales(spark, [("d1", "A", "Alice", 10), ("d2", "A", "Bob", -1)])
    report = Q.validate_testable(df, allowed)
    with pytest.raises(Q.InvalidDays) as e:
        Q.require_valid(report)
    assert e.value.count == 1 and e.value.path in str(e.value)
    assert [r.message for r in spark.read.parquet(e.value.path).collect()] == [
        "Montants négatifs : 1 | Vendeurs inconnus : {'Bob'}"]
    Q.require_valid(report.where("date = 'd1'"))  # a valid report passes


def test_gate_reports_every_bad_day(spark, allowed):
    df = sales(spark, [(f"d{n:02}", "A", "Alice", -1) for n in range(25)])
    with pytest.raises(Q.InvalidDays) as e:
        Q.require_valid(Q.validate_testable(df, allowed))
    assert e.value.count == 25
    assert {r.date for r in spark.read.parquet(e.value.path).collect()} == {f"d{n:02}" for n in range(25)}


def test_expected_days_without_rows_fail(spark, allowed):
    df = sales(spark, [("d1", "A", "Alice", 10)])
    days = spark.createDataFrame([("d1",), ("d2",)], "date string")
    got = {r.date: (r.valid, r.erreurs) for r in Q.validate_testable(df, allowed, expected=days).collect()}
    assert got == {"d1": (True, []), "d2": (False, ["DataFrame vide"])}
    assert {r.date: r.valid for r in Q.validate_final(df, 1, expected=days).collect()} == {"d1": True, "d2": False}
    assert {r.date: r.ok for r in Q.verify_loaded(df, expected=days).collect()} == {"d1": True, "d2": False}
    with pytest.raises(Q.InvalidDays):
        Q.verify_loaded(df, expected=days, stop=True)
    with pytest.raises(Q.InvalidDays):
        Q.reconcile({"raw": days, "clean": df.select("date")}, stop=True)


def test_quarantine_splits_by_day(spark, allowed):
    df = sales(spark, [("d1", "A", "Alice", 10), ("d2", "A", "Alice", -1), ("d2", "B", "Karim", 5)])
    ok, bad = Q.quarantine(df, Q.validate_testable(df, allowed))
    assert sorted(r.date for r in ok.collect()) == ["d1"]
    assert sorted(r.date for r in bad.collect()) == ["d2", "d2"]


def test_reconcile_flags_missing_layer(spark):
    raw = spark.createDataFrame([("d1",), ("d1",), ("d2",)], "date string")
    clean = spark.createDataFrame([("d1",)], "date string")
    r = {x.date: (x.nb_raw, x.nb_clean, x.complet) for x in
         Q.reconcile({"raw": raw, "clean": clean}).collect()}
    assert r == {"d1": (2, 1, True), "d2": (1, 0, False)}


def test_export_keyed_by_month(spark):
    k = spark.createDataFrame([("2024-01-31", 1.0), ("2024-02-01", 2.0)], "date string, ca double")
    folder = scratch_path(spark, "exp")
    p = export_report(k, folder, "2024-02-01")
    assert p.endswith("rapport_mensuel_2024-02")
    assert read_csv(spark, p, k.schema).count() == 2           # every date, as the reference
    p2 = export_report(k, scratch_path(spark, "exp2"), "2024-02-01", month_only=True)
    assert [r.date for r in read_csv(spark, p2, k.schema).collect()] == ["2024-02-01"]


def test_parse_config_defaults(spark):
    df = spark.createDataFrame([('{"seuil_ca": 800}',), ("{}",), ("not json",), (None,)], "raw string")
    got = [tuple(r.c) for r in df.select(
        parse_config("raw", "seuil_ca double, nb_lignes_min int",
                     {"seuil_ca": 5000.0, "nb_lignes_min": 10}).alias("c")).collect()]
    assert got == [(800.0, 10), (5000.0, 10), (5000.0, 10), (5000.0, 10)]


def test_validate_final_rules(spark):
    df = sales(spark, [("d", "A", None, 10), ("d", "A", "x", 0)])
    r = Q.validate_final(df, min_lignes=5).first()
    assert r.erreurs == ["Volume insuffisant : 2 < 5", "Valeurs nulles : 1", "Montants négatifs ou nuls"]
    assert r.valid is False and r.nb == 2
