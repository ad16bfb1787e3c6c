"""Mergeable day states: deltas against a recomputation from the rows."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest

from salesflow.operators import kpis as K
from salesflow.operators import states as S
from salesflow.session import unique_table
from salesflow.sinks import MONTH, ensure_table, rows_of

DDL = "date string, produit string, vendeur string, montant decimal(18,2)"
KPIS = ("date string, ca_total double, marge_totale double, taux_marge double, nb_ventes bigint, panier_moyen double, "
        "top_produit string, top_vendeur string, atteinte_obj double, statut string")


def frame(spark, rows):
    return spark.createDataFrame([(d, p, v, None if m is None else Decimal(m)) for d, p, v, m in rows], DDL)


def rows_of_frame(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_deltas_equal_recomputation(spark, seed):
    """Rows come and go over several deltas; nulls, ties and emptied days."""
    rng = random.Random(seed)
    states, kpis = unique_table("st"), unique_table("k")
    ensure_table(spark, kpis, KPIS, partition=MONTH)
    held, emptied = [], "2024-01-03"
    for lot in range(4):
        come = [(f"2024-0{rng.randint(1, 2)}-0{rng.randint(1, 4)}", rng.choice(["P", "Q", None]), rng.choice(["A", "B", "C", None]),
                 rng.choice([None, "1.00", "2.50", "-1.00", "7.77"])) for _ in range(12)]
        come = [r for r in come if lot < 2 or r[0] != emptied]
        leave = [lot > 0 and (rng.random() < 0.3 or lot == 2 and r[0] == emptied) for r in held]
        gone = [r for r, out in zip(held, leave) if out]
        held = [r for r, out in zip(held, leave) if not out] + come
        S.apply_delta(spark, frame(spark, come), frame(spark, gone) if gone else None, states, kpis, f"l{lot}", 10)
        assert rows_of_frame(rows_of(spark, kpis)) == rows_of_frame(K.kpis_final(frame(spark, held), 10))
    assert emptied not in {r[0] for r in held}


def test_replayed_and_corrected_delta(spark):
    states, kpis = unique_table("st"), unique_table("k")
    ensure_table(spark, kpis, KPIS, partition=MONTH)
    first = frame(spark, [("2024-01-01", "P", "A", "5.00"), ("2024-01-02", "Q", "B", "3.00")])
    for _ in range(2):
        S.apply_delta(spark, first, None, states, kpis, "a", 10)
    assert [(r.date, r.ca_total, r.nb_ventes) for r in rows_of(spark, kpis).orderBy("date").collect()] == [
        ("2024-01-01", 5.0, 1), ("2024-01-02", 3.0, 1)]
    fixed = frame(spark, [("2024-01-01", "P", "A", "6.00")])  # the same load, corrected: a day of it is gone
    S.apply_delta(spark, fixed, None, states, kpis, "a", 10)
    assert [(r.date, r.ca_total, r.top_produit) for r in rows_of(spark, kpis).collect()] == [("2024-01-01", 6.0, "P")]
    S.apply_delta(spark, None, fixed, states, kpis, "b", 10)  # all rows go
    assert rows_of(spark, kpis).isEmpty()


def test_exchange_of_rows_keeps_the_key(spark):
    """One row goes, one comes: the number of rows stays, the cents change."""
    states, kpis = unique_table("st"), unique_table("k")
    ensure_table(spark, kpis, KPIS, partition=MONTH)
    S.apply_delta(spark, frame(spark, [("2024-01-01", "P", "A", "5.00")]), None, states, kpis, "a", 10)
    S.apply_delta(spark, frame(spark, [("2024-01-01", "P", "A", "8.00")]), frame(spark, [("2024-01-01", "P", "A", "5.00")]),
                  states, kpis, "b", 10)
    assert [(r.ca_total, r.nb_ventes) for r in rows_of(spark, kpis).collect()] == [(8.0, 1)]
    with pytest.raises(ValueError):
        S.apply_delta(spark, None, None, states, kpis, "c")


def test_a_day_of_null_amounts(spark):
    rows = frame(spark, [("2024-01-01", "P", None, None), ("2024-01-01", None, "A", None)])
    assert rows_of_frame(S.kpis_of_states(S.merge_states(S.partial_states(rows)), 10)) == rows_of_frame(K.kpis_final(rows, 10))
    assert S.kpis_of_states(S.partial_states(rows.where("1 = 0"))).isEmpty()
