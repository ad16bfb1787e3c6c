"""Late and repeated events: the days of a stream equal those of a batch."""

from __future__ import annotations

import random

from salesflow.session import scratch_path, unique_table
from salesflow.streaming import file_stream, late_events, whole_events_stream

DDL = "event_id bigint, ts timestamp_ntz, value double"


def event(i, day, value=1.0):
    import datetime
    return i, datetime.datetime(2024, 1, day, 12, 0, i % 60), value


def deliver(spark, inbox, rows):
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(inbox)


def days(df):
    return {r.date: (r.nb_evenements, r.valeur_totale, r.nb_tardifs) for r in df.collect()}


def test_late_and_repeated_events_count_once(spark):
    inbox, folder, table = scratch_path(spark, "in"), scratch_path(spark, "w"), unique_table("d")
    schema = spark.createDataFrame([], DDL).schema

    def take():
        return days(whole_events_stream(spark, file_stream(spark, inbox, schema), folder, table))
    deliver(spark, inbox, [event(1, 1), event(1, 1), event(2, 10, 2.5), (3, None, 1.0), (None, event(1, 5)[1], 1.0)])
    assert take() == {"2024-01-01": (1, 1.0, 0), "2024-01-10": (1, 2.5, 0)}
    deliver(spark, inbox, [event(1, 1), event(4, 1, 3.0), event(4, 1, 3.0), event(5, 9, None), event(2, 10, 2.5)])
    want = {"2024-01-01": (2, 4.0, 1), "2024-01-09": (1, None, 0), "2024-01-10": (1, 2.5, 0)}
    # 12 h of day 9 plus 5 s lies above the mark (day 9, 12:00:02)
    assert take() == want and take() == want
    deliver(spark, inbox, [event(4, 1, 3.0), event(6, 2, 1.0)])  # late once more: a repeat, and a new one
    want = want | {"2024-01-02": (1, 1.0, 1)}
    assert take() == want
    assert sorted(r.event_id for r in late_events(spark, schema, folder).collect()) == [4, 6]


def test_shuffled_deliveries_equal_the_batch(spark):
    rng = random.Random(5)
    events = [event(i, rng.randint(1, 20), float(rng.randint(1, 9))) for i in range(120)]
    sent = events + rng.sample(events, 30)
    rng.shuffle(sent)
    inbox, folder, table = scratch_path(spark, "in"), scratch_path(spark, "w"), unique_table("d")
    for n in range(0, 150, 50):
        deliver(spark, inbox, sent[n:n + 50])
        got = days(whole_events_stream(spark, file_stream(spark, inbox, spark.createDataFrame([], DDL).schema), folder, table))
    want = {}
    for _, t, v in events:
        n, s = want.get(str(t.date()), (0, 0.0))
        want[str(t.date())] = (n + 1, s + v)
    assert {d: r[:2] for d, r in got.items()} == want and sum(r[2] for r in got.values()) > 0


def test_a_crash_before_the_days_are_written(spark, monkeypatch):
    import salesflow.streaming.late as late
    inbox, folder, table = scratch_path(spark, "in"), scratch_path(spark, "w"), unique_table("d")
    schema = spark.createDataFrame([], DDL).schema
    deliver(spark, inbox, [event(1, 10)])
    whole_events_stream(spark, file_stream(spark, inbox, schema), folder, table)
    deliver(spark, inbox, [event(2, 1)])
    with monkeypatch.context() as m:
        m.setattr(late, "upsert_kpis", lambda *a: 1 / 0)
        try:
            whole_events_stream(spark, file_stream(spark, inbox, schema), folder, table)
        except ZeroDivisionError:
            pass
    got = days(whole_events_stream(spark, file_stream(spark, inbox, schema), folder, table))
    assert got == {"2024-01-10": (1, 1.0, 0), "2024-01-01": (1, 1.0, 1)}
