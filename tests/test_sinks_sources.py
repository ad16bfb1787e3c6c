"""Load semantics (idempotence, empty day, by-name appends, upserts,
surrogate keys) and file sources."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesflow.session import scratch_path, unique_table
from salesflow.sinks import (MONTH, add_surrogate_key, append_by_name, ensure_table, log_events,
                             replace_day, replace_days, rows_of, upsert_kpis)
from salesflow.sources import read_available, read_csv, read_json_records, read_many, with_fallback

DDL = "date string, vendeur string, montant decimal(18,2)"


def sales(spark, data):
    return spark.createDataFrame([(d, v, Decimal(str(m))) for d, v, m in data], DDL)


def state(spark, t):
    return sorted((r.date, r.vendeur, float(r.montant)) for r in spark.table(t).collect())


def test_replace_day_is_idempotent_and_clears_on_empty(spark):
    t = unique_table("v")
    ensure_table(spark, t, DDL)
    d1 = sales(spark, [("2024-01-01", "Alice", 10), ("2024-01-01", "Karim", 20)])
    d2 = sales(spark, [("2024-01-02", "Lucie", 5)])
    replace_day(spark, d1, t, "2024-01-01")
    replace_day(spark, d2, t, "2024-01-02")
    once = state(spark, t)
    replace_day(spark, d1, t, "2024-01-01")
    assert state(spark, t) == once  # replay = same table
    replace_day(spark, d1.where(F.lit(False)), t, "2024-01-01")
    assert state(spark, t) == [("2024-01-02", "Lucie", 5.0)]  # empty day clears, others kept


def test_replace_day_rejects_rows_of_other_days(spark):
    t = unique_table("v")
    ensure_table(spark, t, DDL)
    with pytest.raises(Exception, match="outside the loaded day"):
        replace_day(spark, sales(spark, [("2024-01-02", "A", 1)]), t, "2024-01-01")


def test_replace_days_many_days(spark):
    t = unique_table("v")
    ensure_table(spark, t, DDL)
    replace_days(spark, sales(spark, [("2024-01-01", "A", 1), ("2024-01-02", "B", 2), ("2024-01-03", "C", 3)]), t)
    replace_days(spark, sales(spark, [("2024-01-02", "Z", 9)]), t, days=["2024-01-02", "2024-01-03"])
    assert state(spark, t) == [("2024-01-01", "A", 1.0), ("2024-01-02", "Z", 9.0)]


def test_append_by_name(spark):
    t = unique_table("v")
    ensure_table(spark, t, DDL)
    append_by_name(spark, sales(spark, [("d", "A", 1)]).select("montant", "date", "vendeur"), t)
    append_by_name(spark, sales(spark, [("d", "B", 2)]).drop("vendeur"), t)
    got = sorted((r.vendeur or "", float(r.montant)) for r in spark.table(t).collect())
    assert got == [("", 2.0), ("A", 1.0)]
    with pytest.raises(ValueError, match="no column"):
        append_by_name(spark, sales(spark, [("d", "A", 1)]).withColumn("extra", F.lit(1)), t)


def test_upsert_kpis_by_month(spark):
    t = unique_table("k")
    ensure_table(spark, t, "date string, ca double", partition=MONTH)
    upsert_kpis(spark, spark.createDataFrame([("2024-01-01", 1.0), ("2024-01-02", 2.0)], "date string, ca double"), t)
    upsert_kpis(spark, spark.createDataFrame([("2024-01-02", 20.0), ("2024-01-03", 3.0)], "date string, ca double"), t)
    upsert_kpis(spark, spark.createDataFrame([("2024-01-02", 20.0), ("2024-01-03", 3.0)], "date string, ca double"), t)
    assert sorted(tuple(r) for r in rows_of(spark, t).collect()) == [("2024-01-01", 1.0), ("2024-01-02", 20.0), ("2024-01-03", 3.0)]


def test_event_log_appends(spark):
    t = unique_table("e")
    ensure_table(spark, t, "date string, type_event string")
    ev = spark.createDataFrame([("d", "ECHEC"), ("d", "RETRY")], "date string, type_event string")
    log_events(spark, ev, t)
    log_events(spark, ev, t)
    assert spark.table(t).count() == 4


def test_surrogate_key_continues_and_is_consecutive(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(5)
    first = add_surrogate_key(df, ["k"], start=1)
    ids = [r.id for r in first.orderBy("k").collect()]
    assert ids == list(range(1, 1001))
    nxt = first.agg((F.max("id") + 1).alias("n"))
    second = add_surrogate_key(spark.range(3).select(F.col("id").alias("k")), ["k"], start=nxt)
    assert sorted(r.id for r in second.collect()) == [1001, 1002, 1003]


def test_csv_na_tokens_and_schema(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text("date,vendeur,montant\n2024-01-01,NA,12.5\n2024-01-01,Alice,nan\n2024-01-01,,3\n")
    df = read_csv(spark, str(p), "date string, vendeur string, montant double")
    got = [(r.vendeur, r.montant) for r in df.collect()]
    assert got[0] == (None, 12.5) and got[1][0] == "Alice" and got[2] == (None, 3.0)


def test_read_many_and_available(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for code, ca in (("idf", 100), ("pac", 200)):
        (inbox / f"region_{code}_2024-01-01.csv").write_text(f"date,region,ca\n2024-01-01,{code},{ca}\n")
    (inbox / "region_idf_2024-01-02.csv").write_text("date,region,ca\n2024-01-02,idf,1\n")
    (inbox / "other_2024-01-01.csv").write_text("date,region,ca\n2024-01-01,x,999\n")
    schema = "date string, region string, ca double"
    got = read_many(spark, str(inbox), schema, prefix="region_", suffix="2024-01-01.csv")
    assert sorted(r.ca for r in got.collect()) == [100.0, 200.0]
    assert read_many(spark, str(inbox), schema, prefix="nothing_") is None
    paths = [str(inbox / "region_idf_2024-01-01.csv"), str(inbox / "missing.csv")]
    assert read_available(spark, paths, schema).count() == 1
    with pytest.raises(ValueError):
        read_available(spark, [str(inbox / "missing.csv")], schema)
    assert read_available(spark, [str(inbox / "missing.csv")], schema, on_empty="none") is None


def test_json_records_keep_columns(spark, tmp_path):
    p = tmp_path / "posts.json"
    p.write_text('[{"id": 1, "userId": 3, "title": "a", "body": "x"}, {"id": 2, "userId": 4, "title": "b"}]')
    df = read_json_records(spark, str(p), "id int, userId int, title string",
                           ["id", "userId", "title"], multi_line=True)
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, 3, "a"), (2, 4, "b")]


def test_fallback_fills_missing_days(spark):
    prim = spark.createDataFrame([("2024-01-01", 5.0, "API_REST")], "date string, montant double, source string")
    back = spark.createDataFrame([("2024-01-01", 1.0), ("2024-01-02", 1200.0)], "date string, montant double")
    got = sorted(tuple(r) for r in with_fallback(prim, back).collect())
    assert got == [("2024-01-01", 5.0, "API_REST"), ("2024-01-02", 1200.0, "FALLBACK")]


def test_scratch_paths_are_under_checkpoint_dir(spark):
    from salesflow.session import checkpoint_dir
    assert scratch_path(spark, "x").startswith(checkpoint_dir(spark).rstrip("/"))
