"""E8 as a ledger: every delivered row is kept, days are admitted or held.

A load writes its rows once, each with the codes of the rules that it
breaks, into a partition of its own (no folder a day, nothing old is
rewritten).  The verdict on a day is not stored in the rows but in an
append-only register, made from the codes alone (the rows are not
evaluated a second time): ``ADMIS`` (no rule broken), ``OUVERT`` (held back)
or ``CLOS`` (held back once, corrected since).  The two layers are the
rows of the latest load that brought a day, by its verdict; rows whose
verdict is not written yet (a crash in between) are in neither: the day
stays as the load before left it, until the load is run again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.operators.quality import null_cells_expr
from salesflow.sinks.tables import ensure_table, replace_partitions

ADMITTED, OPEN, CLOSED = "ADMIS", "OUVERT", "CLOS"
VOLUME, EMPTY = "VOLUME", "VIDE"
REGISTER_DDL = "date string, etat string, raisons array<string>, nb_lignes bigint, nb_fautives bigint, lot bigint"


def standard_rules(df: DataFrame, cols: Sequence[str] | None = None, amount: str = "montant") -> dict[str, Column]:
    """The row rules of the final pipeline: missing cells, amounts not above 0."""
    return {"NULS": null_cells_expr(df, cols) > 0, "MONTANT": F.coalesce(F.col(amount) <= 0, F.lit(False))}


def load_day_rows(spark: SparkSession, df: DataFrame, rules: Mapping[str, Column], table: str, register: str,
                  lot: int, min_lignes: int = 1, days: Sequence[str] | None = None) -> DataFrame:
    """Load number ``lot`` (rising; the same number again replaces what it did).

    ``rules`` name row conditions that must not hold; a null condition is not
    broken.  ``days`` lists days that should have rows: those without any are held
    back as ``VIDE``, their old rows are in no layer any more.  Rows without a
    date are judged together, like a day.  Returns the register's rows of this
    load."""
    ensure_table(spark, register, REGISTER_DDL, partition="lot")
    codes = F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items())), lambda c: c.isNotNull())
    rows = df.withColumn("raisons", codes.cast("array<string>")).withColumn("lot", F.lit(lot).cast("bigint"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    ensure_table(spark, table, ", ".join(fields), partition="lot")
    replace_partitions(spark, rows, table, [str(lot)], "lot")
    replace_partitions(spark, _verdicts(spark, table, register, list(rules), lot, min_lignes, days), register, [str(lot)], "lot")
    return spark.table(register).where(F.col("lot") == lot)


def _verdicts(spark: SparkSession, table: str, register: str, names: list[str], lot: int, min_lignes: int,
              days: Sequence[str] | None) -> DataFrame:
    """One row per day of the load, from the written codes: two narrow columns, folded
    before the shuffle into one count a rule."""
    written = spark.table(table).where(F.col("lot") == lot)
    stats = written.groupBy("date").agg(
        F.count(F.lit(1)).alias("nb_lignes"), F.count_if(F.size("raisons") > 0).alias("nb_fautives"),
        *(F.bool_or(F.array_contains("raisons", n)).alias(f"_r{i}") for i, n in enumerate(names)))
    if days:
        listed = spark.createDataFrame([(d,) for d in sorted(set(days))], "date string")
        stats = listed.join(stats, "date", "full").withColumns(
            {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("nb_lignes", "nb_fautives")})
    reasons = F.filter(F.array(
        *(F.when(F.col(f"_r{i}"), F.lit(n)) for i, n in enumerate(names)),
        F.when(F.col("nb_lignes") == 0, F.lit(EMPTY)).when(F.col("nb_lignes") < min_lignes, F.lit(VOLUME))),
        lambda c: c.isNotNull())
    before = current_verdicts(spark, register, below=lot).select(F.col("date").alias("_d"), F.col("etat").alias("_before"))
    judged = stats.withColumn("raisons", reasons).join(before, F.col("date").eqNullSafe(F.col("_d")), "left")
    state = F.when(F.size("raisons") > 0, OPEN).when(F.col("_before").isin(OPEN, CLOSED), CLOSED).otherwise(ADMITTED)
    return judged.select("date", state.alias("etat"), "raisons", "nb_lignes", "nb_fautives", F.lit(lot).cast("bigint").alias("lot"))


def current_verdicts(spark: SparkSession, register: str, below: int | None = None) -> DataFrame:
    """The latest verdict on each day (of loads under ``below``): a row a day."""
    r = spark.table(register)
    r = r if below is None else r.where(F.col("lot") < below)
    last = r.groupBy("date").agg(F.max("lot").alias("_lot")).withColumnRenamed("date", "_day")
    return r.join(last, F.col("date").eqNullSafe(F.col("_day")) & (F.col("lot") == F.col("_lot"))).drop("_day", "_lot")


def layers(spark: SparkSession, table: str, register: str) -> tuple[DataFrame, DataFrame]:
    """(admitted, held back): all rows of the days so judged, each with its codes.
    Loads that no day stands on any more are pruned as they are read."""
    now = current_verdicts(spark, register)
    rows = spark.table(table)

    def of(cond: Column) -> DataFrame:
        judged = now.where(cond).select(F.col("date").alias("_day"), F.col("lot").alias("_lot"))
        return rows.join(judged, F.col("date").eqNullSafe(F.col("_day")) & (F.col("lot") == F.col("_lot")), "left_semi")
    return of(F.col("etat") != OPEN), of(F.col("etat") == OPEN)
