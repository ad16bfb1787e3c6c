"""Steps that moved, sorted or joined the same rows again as tables grow."""

import glob

import pyarrow.parquet as pq

from salesflow import layout
from salesflow.operators import quality as Q
from salesflow.operators import states as S
from salesflow.registry import q_jobs, q_sinks
from salesflow.session import unique_table
from salesflow.sinks import MONTH, ensure_table, replace_days
from tests.conftest import SCHEMA_4, D
from tests.test_plans import SF, plan

ROWS = [("2024-01-01", "P", "A", D(5)), ("2024-01-01", None, "X", D(-1)), ("2024-01-01", "P", None, D(2)),
        ("2024-01-02", "Q", "A", D(3)), (None, "Q", "Y", None)]


def test_validation_folds_rows_before_it_collects_unknown_sellers(spark):
    df = spark.createDataFrame(ROWS, SCHEMA_4)
    report = Q.validate_testable(df, spark.createDataFrame([("A",)], "vendeur string"))
    got = {r["date"]: r for r in report.collect()}
    assert [(got[d]["valid"], got[d]["nb_lignes"], len(got[d]["erreurs"])) for d in ("2024-01-01", "2024-01-02", None)] \
        == [(False, 3, 3), (True, 1, 0), (False, 1, 2)]
    assert "_unknown" in plan(report)
    empty = Q.validate_testable(df.limit(0), None, by=None).first()
    assert (empty["nb_lignes"], empty["valid"]) == (0, False)


def test_rows_by_day_are_loaded_without_a_shuffle(spark):
    name = unique_table("jours")
    ensure_table(spark, name, "date string, produit string, vendeur string, montant decimal(18,2)")
    rows = layout.by_day(spark, spark.createDataFrame(ROWS[:4], SCHEMA_4))
    for _ in range(2):
        replace_days(spark, rows, name, grouped=True)
    assert sorted(map(str, spark.table(name).select(*rows.columns).collect())) == sorted(map(str, rows.collect()))
    replace_days(spark, rows.where("vendeur = 'X'"), name, days=["2024-01-01", "2024-01-02"], grouped=True)
    assert [r["vendeur"] for r in spark.table(name).collect()] == ["X"]


def test_replay_joins_the_sales_once(spark):
    seen = []
    q_jobs.replay(spark, SF, lambda rows, days: seen.append(plan(rows)), land=True)
    assert len(seen) == 3 and not any("Join" in p for p in seen)


def test_loads_of_a_day_twice_join_the_sales_once(spark, monkeypatch):
    seen, load = [], q_sinks.replace_days
    monkeypatch.setattr(q_sinks, "replace_days", lambda s, df, *a, **k: (seen.append(plan(df)), load(s, df, *a, **k)))
    q_sinks.b4_replace_day(spark, SF)
    assert seen and not any("Join" in p for p in seen)


def test_buckets_grow_with_the_facts(spark, monkeypatch):
    monkeypatch.setattr(layout, "BUCKET_BYTES", 1 + layout._bytes(spark, SF) // 20)
    prefix = unique_table("facts")
    layout.bucket_facts(spark, SF, prefix)
    rows = spark.sql(f"DESCRIBE EXTENDED {prefix}_lineitem").collect()
    assert [int(r["data_type"]) for r in rows if r["col_name"] == "Num Buckets"] == [20]


def test_states_of_a_load_lie_sorted_by_date(spark):
    states, kpis = unique_table("states"), unique_table("kpis")
    ensure_table(spark, kpis, q_sinks.KPI_SCHEMA, partition=MONTH)
    rows = [(f"2024-01-{d:02d}", f"P{i}", f"A{i}", D(i + d)) for i in range(40) for d in range(1, 29)]
    S.apply_delta(spark, spark.createDataFrame(rows, SCHEMA_4), None, states, kpis, "a", 10)
    where = spark.sql(f"DESCRIBE EXTENDED {states}").where("col_name = 'Location'").first()["data_type"]
    files = glob.glob(f"{where.removeprefix('file:')}/lot=a/*.parquet")
    for f in files:
        dates = pq.read_table(f, columns=["date"])["date"].to_pylist()
        assert dates == sorted(dates)
    assert files and spark.table(kpis).count() == 28
