"""The quarantine ledger and value sets in chunks."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesflow.operators import ledger as L
from salesflow.operators import quality as Q
from salesflow.session import unique_table

DDL = "date string, vendeur string, montant decimal(18,2)"


def frame(spark, *rows):
    return spark.createDataFrame([(d, v, None if m is None else Decimal(m)) for d, v, m in rows], DDL)


def load(spark, names, lot, *rows, **kw):
    df = frame(spark, *rows)
    return L.load_day_rows(spark, df, L.standard_rules(df), *names, lot, **kw)


def verdicts(spark, names):
    return {r.date: (r.etat, tuple(r.raisons), r.nb_lignes, r.nb_fautives) for r in L.current_verdicts(spark, names[1]).collect()}


def dates(df):
    return sorted(str(r.date) for r in df.select("date").collect())


def test_rejected_corrected_readmitted(spark):
    names = unique_table("rows"), unique_table("reg")
    load(spark, names, 1, ("2024-01-01", "A", "5"), ("2024-01-02", "A", "-1"), ("2024-01-02", "B", None), ("2024-01-03", None, "2"))
    assert verdicts(spark, names) == {
        "2024-01-01": ("ADMIS", (), 1, 0), "2024-01-02": ("OUVERT", ("NULS", "MONTANT"), 2, 2), "2024-01-03": ("OUVERT", ("NULS",), 1, 1)}
    ok, held = L.layers(spark, *names)
    assert dates(ok) == ["2024-01-01"] and dates(held) == ["2024-01-02"] * 2 + ["2024-01-03"]
    for _ in range(2):  # a replay changes nothing
        load(spark, names, 2, ("2024-01-02", "A", "1"), ("2024-01-02", "B", "3"), ("2024-01-01", "A", "0"))
        assert verdicts(spark, names) == {
            "2024-01-01": ("OUVERT", ("MONTANT",), 1, 1), "2024-01-02": ("CLOS", (), 2, 0), "2024-01-03": ("OUVERT", ("NULS",), 1, 1)}
        ok, held = L.layers(spark, *names)
        assert dates(ok) == ["2024-01-02"] * 2 and dates(held) == ["2024-01-01", "2024-01-03"]
    load(spark, names, 3, ("2024-01-02", "A", "9"))  # corrected once more: still a day that was held back
    assert verdicts(spark, names)["2024-01-02"] == ("CLOS", (), 1, 0)
    assert spark.table(names[1]).count() == 6  # the history of verdicts stays


def test_empty_and_small_days(spark):
    names = unique_table("rows"), unique_table("reg")
    load(spark, names, 1, ("2024-01-01", "A", "5"), ("2024-01-02", "A", "5"), ("2024-01-02", "B", "5"), min_lignes=2)
    assert verdicts(spark, names) == {"2024-01-01": ("OUVERT", ("VOLUME",), 1, 0), "2024-01-02": ("ADMIS", (), 2, 0)}
    load(spark, names, 2, min_lignes=2, days=["2024-01-02"])  # its rows are gone
    assert verdicts(spark, names)["2024-01-02"] == ("OUVERT", ("VIDE",), 0, 0)
    ok, held = L.layers(spark, *names)
    assert ok.isEmpty() and dates(held) == ["2024-01-01"]


def test_rows_without_a_verdict_are_in_no_layer(spark, monkeypatch):
    names = unique_table("rows"), unique_table("reg")
    load(spark, names, 1, ("2024-01-01", "A", "5"))
    with monkeypatch.context() as m:
        m.setattr(L, "replace_partitions", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            load(spark, names, 2, ("2024-01-01", "A", "-5"))
    ok, held = L.layers(spark, *names)  # as the load before left it
    assert [(r.date, r.montant) for r in ok.collect()] == [("2024-01-01", Decimal("5.00"))] and held.isEmpty()
    load(spark, names, 2, ("2024-01-01", "A", "-5"))
    assert dates(L.layers(spark, *names)[1]) == ["2024-01-01"]


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_chunks_hold_every_value_once(spark, size):
    df = spark.range(3000).select(F.when(F.col("id") < 2500, "d1").when(F.col("id") < 2990, "d2").alias("date"),
                                  F.format_string("v%05d", F.col("id") % 2600).alias("v"))
    df = df.union(spark.createDataFrame([("d1", None), ("d3", None)], "date string, v string"))
    want = {}
    for r in df.distinct().where("v is not null").collect():
        want.setdefault(r.date, []).append(r.v)
    got = Q.value_chunks(df, "v", size).collect()
    assert {r.date for r in got} == {"d1", "d2", None}
    for day, values in want.items():
        chunks = sorted((r for r in got if r.date == day), key=lambda r: r.morceau)
        assert [r.morceau for r in chunks] == list(range(-(-len(values) // size)))
        assert all(r.nb == len(r.valeurs) <= size and r.nb_total == len(values) for r in chunks)
        assert [v for r in chunks for v in r.valeurs] == sorted(values)


def test_chunks_without_groups_or_rows(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",)], "v string")
    assert [tuple(r) for r in Q.value_chunks(df, "v", 5, by=None).collect()] == [(0, 2, 2, ["a", "b"])]
    assert Q.value_chunks(df.where("v = 'z'"), "v", 5, by=None).isEmpty()
