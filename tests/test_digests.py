"""Reconciliation by content against plain counters of rows."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from salesflow.operators import digests as D
from salesflow.operators.quality import InvalidDays

DDL = "date string, a string, b string, n int"


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL).repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
def test_differences_equal_counters(spark, seed):
    """Random rows with nulls, repeats and days that only one layer has."""
    rng = random.Random(seed)
    left = [(rng.choice(["d1", "d2", "d3", "d4", None]), rng.choice(["x", None]), rng.choice(["x", "", None]), rng.choice([1, None]))
            for _ in range(60)]
    right = [r for r in left if r[0] != "d1"]
    right[0] = (right[0][0], "altered", right[0][2], right[0][3])
    right += [("d5", "x", "x", 1), right[5]]
    rng.shuffle(right)
    a, b = Counter(left), Counter(right)
    got = D.content_differences(frame(spark, left), frame(spark, right)).collect()
    assert {tuple(r)[:4]: r.ecart for r in got} == {k: a[k] - b[k] for k in a | b if a[k] != b[k]}
    days = {r[0] for r in left + right}
    same = {d: Counter(r for r in left if r[0] == d) == Counter(r for r in right if r[0] == d) for d in days}
    out = D.reconcile_content({"l": frame(spark, left), "r": frame(spark, right)}).collect()
    assert {r.date: (r.nb_l, r.nb_r, r.identique) for r in out} == {
        d: (sum(r[0] == d for r in left), sum(r[0] == d for r in right), same[d]) for d in days}


def test_a_value_that_moves_to_a_null_column_counts(spark):
    left, right = frame(spark, [("d", "x", None, 1)]), frame(spark, [("d", None, "x", 1)])
    assert not D.reconcile_content({"l": left, "r": right}).first().identique


def test_exchanged_and_repeated_rows(spark):
    one, two = ("d", "x", "y", 1), ("d", "y", "x", 2)
    assert not D.reconcile_content({"l": frame(spark, [one, one, two]), "r": frame(spark, [one, two, two])}).first().identique
    assert D.reconcile_content({"l": frame(spark, [one, one, two]), "r": frame(spark, [two, one, one])}).first().identique


def test_loads_add_up(spark):
    rows = [(f"d{i % 3}", str(i % 5), None, i % 7) for i in range(50)]
    parts = [D.day_digests(frame(spark, rows[i::4])) for i in range(4)]
    whole = sorted(tuple(r) for r in D.day_digests(frame(spark, rows)).collect())
    assert sorted(tuple(r) for r in D.merge_digests(*parts).collect()) == whole


def test_empty_layers_and_stop(spark):
    none, some = spark.createDataFrame([], DDL), frame(spark, [("d", "x", None, 1)])
    assert D.reconcile_content({"l": none, "r": none}).isEmpty()
    assert D.content_differences(none, none).isEmpty()
    assert D.reconcile_content({"l": some, "m": some, "r": none}).first().identique is False
    D.reconcile_content({"l": some, "r": some}, stop=True)
    with pytest.raises(InvalidDays) as e:
        D.reconcile_content({"l": some, "r": none}, stop=True)
    assert e.value.count == 1


def test_other_types_and_columns_of_the_second_layer(spark):
    left = frame(spark, [("d", "x", "y", 1)])
    right = left.selectExpr("cast(n as bigint) n", "b", "a", "date", "'more' as extra")
    assert D.reconcile_content({"l": left, "r": right}).first().identique
    assert not D.reconcile_content({"l": left, "r": right.withColumn("b", right.a)}).first().identique
    assert D.reconcile_content({"l": left, "r": right.withColumn("b", right.a)}, cols=["a", "n"]).first().identique
