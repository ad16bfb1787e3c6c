"""Mergeable day states: KPIs kept up to date by deltas.

A state is what a day's KPIs need and no more: for each product and each seller
of a day the cents sold, the cents of margin, the rows and the rows with an
amount.  States add up, so the states of rows that come are added and those of
rows that go are subtracted; the day's earlier rows are not read again.

The table is partitioned by load (``lot``): a delta is written as a partition of
its own, and one that is loaded again replaces itself, so a replay or a repeated
run changes nothing.  A reader adds up the loads.  Rows lie sorted by date within
a load, so that file statistics leave out the loads without a wanted day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.functions.numeric import cents, margin
from salesflow.operators import kpis as K
from salesflow.sinks.tables import ensure_table, replace_partitions, upsert_kpis

DIMENSIONS = ("produit", "vendeur")
STATES_DDL = ("date string, dimension string, cle string, cents bigint, marge_cents bigint, nb bigint, "
              "nb_montants bigint, lot string")
_SUMS = ("cents", "marge_cents", "nb", "nb_montants")


def partial_states(rows: DataFrame, sign: int = 1) -> DataFrame:
    """The states of sales rows, one GROUPING SETS pass with map-side sums;
    ``sign=-1`` for rows that go."""
    m = F.col("marge") if "marge" in rows.columns else margin("montant")
    first = K._partials(rows, "date", DIMENSIONS, {"marge": F.sum(cents(m)), "amounts": F.count("montant")})
    is_product = F.col("_g_produit") == 0
    return first.select(
        "date", F.when(is_product, DIMENSIONS[0]).otherwise(DIMENSIONS[1]).alias("dimension"),
        F.when(is_product, F.col("produit")).otherwise(F.col("vendeur")).alias("cle"),
        *((F.coalesce(c, F.lit(0)) * sign).cast("bigint").alias(n)
          for n, c in zip(_SUMS, map(F.col, ("_s", "_x_marge", "_n", "_x_amounts")))))


def merge_states(*states: DataFrame) -> DataFrame:
    """States added up; a product or seller without a row left is gone."""
    every = states[0]
    for s in states[1:]:
        every = every.unionByName(s)
    return every.groupBy("date", "dimension", "cle").agg(*(F.sum(n).alias(n) for n in _SUMS)).where("nb <> 0")


def kpis_of_states(states: DataFrame, objectif: float = 50000) -> DataFrame:
    """The final day KPIs (G7) of states, equal to those of the rows."""
    amount = F.col("nb_montants") != 0  # no amount at all: null, not zero
    first = states.select(
        "date", *(F.when(F.col("dimension") == d, F.col("cle")).alias(d) for d in DIMENSIONS),
        *((F.col("dimension") != d).cast("int").alias(f"_g_{d}") for d in DIMENSIONS),
        F.when(amount, F.col("cents")).alias("_s"), F.col("nb").alias("_n"), F.when(amount, F.col("marge_cents")).alias("_x_marge"))
    return K.final_columns(K._totals(first, "date", DIMENSIONS, ["marge"], False, ["marge"]), objectif)


def apply_delta(spark: SparkSession, added: DataFrame | None, removed: DataFrame | None, states: str, kpis: str,
                lot: str, objectif: float = 50000) -> DataFrame:
    """Load one delta under its name ``lot`` and bring the KPIs of the days it
    touches up to date (B5); a day without a row left keeps no KPI.

    ``states`` (made if absent) and ``kpis`` are tables.  The same ``lot`` again
    replaces what it loaded before, its days included.  Null dates are left out.
    Returns the touched days."""
    if added is None and removed is None:
        raise ValueError("a delta adds rows, removes rows, or both")
    ensure_table(spark, states, STATES_DDL, partition="lot")
    parts = [partial_states(d, s) for d, s in ((added, 1), (removed, -1)) if d is not None]
    mine = F.col("lot") == lot
    before = [r["date"] for r in spark.table(states).where(mine).select("date").distinct().toLocalIterator()]
    delta = merge_states(*parts) if len(parts) == 1 else _net(*parts)
    delta = delta.where("date is not null").withColumn("lot", F.lit(lot)).sortWithinPartitions("lot", "date")
    replace_partitions(spark, delta, states, [lot], "lot", grouped=True)  # one partition: nothing to bring together
    after = [r["date"] for r in spark.table(states).where(mine).select("date").distinct().toLocalIterator()]
    days = sorted({*before, *after})  # bounded by the calendar
    touched = spark.createDataFrame([(d,) for d in days], "date string")
    if days:
        held = spark.table(states).drop("lot").where(F.col("date").between(days[0], days[-1])).join(touched, "date", "left_semi")
        upsert_kpis(spark, kpis_of_states(merge_states(held), objectif), kpis, days=days)
    return touched


def _net(plus: DataFrame, minus: DataFrame) -> DataFrame:
    """A delta's own sums: a key whose rows are exchanged one for one stays."""
    every = plus.unionByName(minus)
    changed = " or ".join(f"{n} <> 0" for n in _SUMS)
    return every.groupBy("date", "dimension", "cle").agg(*(F.sum(n).alias(n) for n in _SUMS)).where(changed)
