"""Ids in reserved blocks: conflicts, replays, loads at once."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from salesflow.session import scratch_path, unique_table
from salesflow.sinks import ensure_table
from salesflow.sinks import id_blocks as B


def rows(spark, lo, hi):
    return spark.range(lo, hi).withColumnRenamed("id", "k")


def made(spark):
    t = unique_table("t")
    return ensure_table(spark, t, "id bigint, k bigint, lot string", partition="lot"), scratch_path(spark, "log")


def ids(spark, t):
    return {r.k: r.id for r in spark.table(t).collect()}


def test_replay_correction_and_empty_load(spark):
    t, log = made(spark)
    B.append_with_id_blocks(spark, rows(spark, 0, 40), t, ["k"], log, "a")
    B.append_with_id_blocks(spark, rows(spark, 100, 130), t, ["k"], log, "b")
    first = ids(spark, t)
    assert sorted(first.values()) == list(range(1, 71))
    B.append_with_id_blocks(spark, rows(spark, 0, 40), t, ["k"], log, "a")
    assert ids(spark, t) == first
    B.append_with_id_blocks(spark, rows(spark, 0, 41), t, ["k"], log, "a")  # a row more: a new block
    got = ids(spark, t)
    assert sorted(got[k] for k in range(41)) == list(range(71, 112)) and all(got[k] == first[k] for k in range(100, 130))
    B.append_with_id_blocks(spark, rows(spark, 0, 0), t, ["k"], log, "a")
    assert set(ids(spark, t)) == set(range(100, 130))


def test_a_claim_between_reading_and_claiming(spark, monkeypatch):
    """Another load takes the number that this one was about to take."""
    log, claim, taken = scratch_path(spark, "log"), B._claim, []

    def late(s, path, entry):
        if not taken:
            taken.append(claim(s, path, {**entry, "lot": "other", "nombre": 7}))
        return claim(s, path, entry)
    monkeypatch.setattr(B, "_claim", late)
    assert B.reserve_ids(spark, log, "t", "mine", 5, 8) == 8 and taken == [True]
    assert sorted((r.numero, r.premier, r.nombre, r.lot) for r in B._entries(spark, log).collect()) == [
        (1, 1, 7, "other"), (2, 8, 5, "mine")]


def test_loads_at_once(spark):
    log = scratch_path(spark, "log")
    with ThreadPoolExecutor(4) as pool:
        firsts = list(pool.map(lambda n: B.reserve_ids(spark, log, "t", f"l{n}", 10, 8), range(4)))
    assert sorted(firsts) == [1, 11, 21, 31]
