"""Partitioned tables and their load semantics.

Tables are ``USING parquet PARTITIONED BY (date)`` in the warehouse (or at
a given location), so a day is a directory: replacing a day rewrites that
directory only, and readers filtering on the date list and read that
directory only.  KPI tables, with a row or a few per day, are partitioned
by month (``MONTH``): an upsert rewrites the months that it touches.
Replacements are staged by Spark and moved in when the write is done, so a
crash leaves the old partitions.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Partition column of KPI tables: the ``yyyy-MM`` of their ``date``.
MONTH = "mois"
_DYNAMIC = "spark.sql.sources.partitionOverwriteMode"


def _name(table: str) -> str:
    """``table`` if it is a plain (qualified) identifier, else an error."""
    if not re.fullmatch(r"\w+(\.\w+){0,2}", table):
        raise ValueError(f"not a table name: {table!r}")
    return table


def _day(ds: str) -> str:
    """``ds`` if it is a ``yyyy-MM-dd`` date, else an error."""
    return datetime.date.fromisoformat(ds).isoformat()


def ensure_table(spark: SparkSession, name: str, ddl: str, partition: str | None = "date",
                 location: str | None = None) -> str:
    """B2: ``CREATE TABLE IF NOT EXISTS`` with a fixed DDL column list.
    ``partition=MONTH`` adds that column.  Without a ``location`` the table
    lies in the warehouse."""
    cols = f"{ddl}, {MONTH} string" if partition == MONTH else ddl
    part = f" PARTITIONED BY ({partition})" if partition else ""
    where = " LOCATION '{}'".format(location.replace("'", "\\'")) if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(name)} ({cols}) USING parquet{part}{where}")
    return name


def rows_of(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a table without its month column."""
    return spark.table(table).drop(MONTH)


def _by_name(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    """Columns of ``df`` in the table's order, matched by name; a column
    the table lacks is an error, a column ``df`` lacks is null."""
    target = spark.table(table).schema
    names = [f.name for f in target.fields]
    extra = [c for c in df.columns if c not in names]
    if extra:
        raise ValueError(f"table {table} has no column named {extra}")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in target.fields])


def for_partitioned_write(df: DataFrame, key: str = "date") -> DataFrame:
    """Group rows by partition value before a partitioned write, so a day
    becomes few files.  ``rebalance`` (not ``repartition``) lets AQE split
    a hot day over several tasks and merge small ones."""
    return df.hint("rebalance", key)


def _partition_key(spark: SparkSession, table: str) -> str | None:
    cols = [c for c in spark.catalog.listColumns(table) if c.isPartition]
    return cols[0].name if cols else None


def _insert(spark: SparkSession, df: DataFrame, table: str, overwrite: bool, grouped: bool = False) -> None:
    """Append, or replace the partitions that ``df`` has rows of.  ``grouped``:
    its rows lie by partition value already and are not shuffled again.  The
    overwrite mode must be dynamic for that: ``get_spark`` sets it once; a
    session without it is set here and stays so (switching back and forth
    would race with another load of the session)."""
    if overwrite and spark.conf.get(_DYNAMIC, "static").lower() != "dynamic":
        spark.conf.set(_DYNAMIC, "dynamic")
    data = _by_name(spark, df, table)
    key = _partition_key(spark, table)
    if key and not grouped:
        data = for_partitioned_write(data, key)
    data.write.insertInto(table, overwrite=overwrite)


def append_by_name(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Append, matching columns by name."""
    _insert(spark, df, table, overwrite=False)


def log_events(spark: SparkSession, events: DataFrame, table: str) -> None:
    """Append-only event log (never overwritten)."""
    append_by_name(spark, events, table)


def replace_day(spark: SparkSession, df: DataFrame, table: str, ds: str,
                key: str = "date") -> None:
    """Idempotent load of one day.

    ``INSERT OVERWRITE ... PARTITION (date = ds)`` replaces exactly that
    day: replaying gives the same table, an empty frame clears the day,
    other days are untouched.  A row whose date is not ``ds`` fails the
    job (checked inside the write, no extra pass).
    """
    ds = _day(ds)
    cols = [c for c in spark.table(table).columns if c != key]
    on_day = F.when(F.col(key) == F.lit(ds), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("row outside the loaded day: "),
                               F.coalesce(F.col(key), F.lit("null")))).cast("boolean"))
    checked = _by_name(spark, df.where(on_day), table).select(*cols)
    spark.sql(f"INSERT OVERWRITE TABLE {_name(table)} PARTITION ({key} = '{ds}') "
              "SELECT * FROM {rows}", rows=checked)


def replace_days(spark: SparkSession, df: DataFrame, table: str,
                 days: Sequence[str] | None = None, key: str = "date", grouped: bool = False) -> None:
    """B4, many days in one job: dynamic partition overwrite replaces the
    days present in ``df`` and leaves the others.  Days listed in
    ``days`` but absent from ``df`` are cleared too: each gets a static
    overwrite with no rows, which deletes its files.

    Which listed days had rows is observed during the write (a set bounded
    by ``days``), so the input is evaluated once.  ``grouped`` says that the
    rows of a day lie together already (``layout.by_day``, a table by day):
    they are written where they are read, without a shuffle."""
    if not days:
        _insert(spark, df, table, overwrite=True, grouped=grouped)
        return
    replace_partitions(spark, df, table, [_day(d) for d in days], key, grouped)


def replace_partitions(spark: SparkSession, df: DataFrame, table: str, values: Sequence[str],
                       key: str, grouped: bool = False) -> None:
    """Partitions present in ``df`` are replaced, those of the listed
    ``values`` (of any kind) that ``df`` has no rows of are cleared."""
    listed = sorted(set(values))
    seen = Observation()
    text = F.col(key).cast("string")
    wanted = F.when(text.isin(listed), text)
    _insert(spark, df.observe(seen, F.collect_set(wanted).alias("values")), table, overwrite=True, grouped=grouped)
    for v in sorted(set(listed) - _observed(seen, "values")):
        _clear(spark, table, key, v)


def _observed(seen: Observation, name: str) -> set[str]:
    """The observed set.  A write whose input Spark knows to be empty runs
    no plan and reports no row: nothing was written then."""
    try:
        return set(seen.get[name] or ())
    except Py4JJavaError:
        return set()


def _clear(spark: SparkSession, table: str, key: str, value: str) -> None:
    """Empty one partition, its files included."""
    fields = [f for f in spark.table(table).schema.fields if f.name != key]
    literal = value.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"INSERT OVERWRITE TABLE {_name(table)} PARTITION ({key} = '{literal}') "
              "SELECT * FROM {rows}", rows=spark.createDataFrame([], T.StructType(fields)))


def upsert_kpis(spark: SparkSession, kpis: DataFrame, table: str,
                key: str | Sequence[str] = "date", days: Sequence[str] | None = None) -> None:
    """Keyed upsert: rows whose key is in ``kpis`` are replaced, the
    others kept.  All old rows of the listed ``days`` go, so that a day that
    became empty or invalid keeps no KPI.

    The table is partitioned by month (``ensure_table(partition=MONTH)``,
    one of the keys is ``date``) or by its one key.  Only the partitions
    that ``kpis`` touches are read, merged and replaced, in one dynamic
    overwrite: a replayed call gives the same table.
    """
    keys = [key] if isinstance(key, str) else list(key)
    part = _partition_key(spark, table)
    if keys == [part]:
        replace_days(spark, kpis, table, days=days, key=part)
        return
    if part != MONTH or "date" not in keys:
        raise ValueError(f"{table} must be partitioned by {keys[0]} or by month")
    new = kpis.withColumn(MONTH, F.substring("date", 1, 7))
    touched = new.select(MONTH)
    listed = sorted({_day(d) for d in days or ()})
    months = sorted({d[:7] for d in listed})
    if listed:
        touched = touched.union(spark.createDataFrame([(m,) for m in months], f"{MONTH} string"))
    old = spark.table(table).join(touched.distinct(), MONTH, "left_semi").where(~F.col("date").isin(listed))
    merged = upsert_frame(old, _by_name(spark, new, table), keys)
    if not listed:
        _insert(spark, merged, table, overwrite=True)
        return
    seen = Observation()
    wanted = F.when(F.col(MONTH).isin(months), F.col(MONTH))
    _insert(spark, merged.observe(seen, F.collect_set(wanted).alias("months")), table, overwrite=True)
    for m in sorted(set(months) - _observed(seen, "months")):  # nothing is left of the month
        _clear(spark, table, MONTH, m)


def upsert_frame(old: DataFrame, new: DataFrame, key: str | Sequence[str] = "date") -> DataFrame:
    """B5, set form for unpartitioned data: old rows whose key is not in
    ``new``, plus ``new``."""
    keys = [key] if isinstance(key, str) else list(key)
    return old.join(new.select(*keys).distinct(), keys, "left_anti") \
              .unionByName(new, allowMissingColumns=True)


def add_surrogate_key(df: DataFrame, order: Sequence[str], start: int | DataFrame = 1,
                      col: str = "id") -> DataFrame:
    """Consecutive integer ids in ``order`` (a total order), from
    ``start`` (an int, or a one-row frame holding the next free id).  Give
    only the columns that are needed: the frame is sorted as a whole.

    No global window: the rows are range-partitioned and sorted, the
    frame is checkpointed to the shared checkpoint folder (so the
    partitioning cannot change between the two uses below, and lineage
    is cut), each partition counts its rows, and a running offset over
    the partition counts (one row per partition) is joined back.
    """
    base = df.orderBy(*order).withColumn("_pid", F.spark_partition_id()) \
             .withColumn("_mid", F.monotonically_increasing_id())
    base = base.checkpoint(eager=True)
    counts = base.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_pid", (F.sum("_cnt").over(Window.orderBy("_pid")) - F.col("_cnt")).alias("_off"))
    first_id = start.select(start.columns[0]).scalar() if isinstance(start, DataFrame) \
        else F.lit(start)
    offsets = offsets.withColumn("_start", first_id)
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return base.join(F.broadcast(offsets), "_pid").withColumn(
        col, (F.col("_start") + F.col("_off") + local).cast("long")) \
        .drop("_pid", "_mid", "_off", "_start")


def append_with_ids(spark: SparkSession, df: DataFrame, table: str, order: Sequence[str],
                    marks: str, col: str = "id") -> None:
    """B7 in a load: append ``df`` to ``table`` with ids above every id that
    was ever given out for it.

    ``marks`` (made if absent) is an append-only table of high-water marks:
    the new mark is written before the rows, so ids are not reused after a
    delete or a crash."""
    ensure_table(spark, marks, "nom string, dernier_id bigint", partition=None)
    last = spark.table(marks).where(F.col("nom") == table).agg(
        F.coalesce(F.max("dernier_id"), F.lit(0)).alias("last"))
    start = int(last.first()["last"])
    rows = add_surrogate_key(df, order, start + 1, col).checkpoint()
    top = rows.agg(F.max(col).alias("dernier_id")).where("dernier_id is not null")
    append_by_name(spark, top.select(F.lit(table).alias("nom"), "dernier_id"), marks)
    append_by_name(spark, rows, table)
