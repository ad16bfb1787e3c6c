"""The sales tables laid out for reports.

Lineitem and orders are stored once, bucketed and sorted by order key in equal
numbers of buckets, so that their join moves no row: the one join of two tables
that both grow.  ``ventes`` is loaded once from that join, partitioned by month
and sorted by date within its files.  Reports then read it: no join is repeated,
a period lists only its months, and within a month file statistics skip the other
days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.session import scratch_path, unique_table
from salesflow.sinks.tables import MONTH
from salesflow.views import table, ventes

#: Bytes of a stored fact table that a bucket holds at most, as its files have them.
BUCKET_BYTES = 16 << 20
FACT_KEYS = {"lineitem": "l_orderkey", "orders": "o_orderkey"}


def bucket_facts(spark: SparkSession, sf_dir: str, prefix: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """Store the fact tables as ``<prefix>_lineitem`` and ``<prefix>_orders``.

    ``buckets`` bounds the parallelism of the join.  By default they grow with
    the tables (the shuffle partitions, or more, so that a bucket of the larger
    one has ``BUCKET_BYTES``) and a bucket is sorted in a task's memory.
    Rows are dealt out by key before the write, so that a bucket is one file;
    the writer sorts it."""
    n = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-_bytes(spark, sf_dir) // BUCKET_BYTES))
    for name, key in FACT_KEYS.items():
        (table(spark, sf_dir, name).repartition(n, key)
         .write.bucketBy(n, key).sortBy(key).saveAsTable(f"{prefix}_{name}"))
    return {name: spark.table(f"{prefix}_{name}") for name in FACT_KEYS}


def _bytes(spark: SparkSession, sf_dir: str) -> int:
    """Bytes of the larger fact table's files."""
    return max(spark.read.format("binaryFile").option("recursiveFileLookup", "true")
               .load(f"{sf_dir.rstrip('/')}/{t}.parquet").agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
               for t in FACT_KEYS)


def by_day(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows with a ``date``, computed once and written with those of a day
    together, sorted by date: what reads them lists a day's row groups only, and
    loads them by day without a shuffle (``replace_days(grouped=True)``)."""
    path = scratch_path(spark, "jours")
    rows.hint("rebalance", "date").sortWithinPartitions("date").write.parquet(path)
    return spark.read.parquet(path)


def load_sales(spark: SparkSession, sf_dir: str, facts: dict[str, DataFrame], name: str) -> DataFrame:
    """Load ``ventes`` from stored fact tables, partitioned by month.  The table
    appears when the load is whole."""
    rows = ventes(spark, sf_dir, facts).withColumn(MONTH, F.substring("date", 1, 7))
    rows.hint("rebalance", MONTH).sortWithinPartitions(MONTH, "date").write.partitionBy(MONTH).saveAsTable(name)
    return spark.table(name)


def period(sales: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """The rows from the day ``first`` to ``last``: a partition filter on the
    month, and the dates within it."""
    for day, op in ((first, "__ge__"), (last, "__le__")):
        if day is not None:
            sales = sales.where(getattr(F.col(MONTH), op)(day[:7]) & getattr(F.col("date"), op)(day))
    return sales.drop(MONTH)


_STORED: dict[tuple[str, str, str], str] = {}


def stored_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ventes`` as a stored table, loaded by the first caller of a session and
    again when a source file has changed (its path, size or time)."""
    files = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in (*FACT_KEYS, "part", "supplier", "nation", "region")]
    seen = (spark.read.format("binaryFile").load(files)
            .agg(F.xxhash64(F.to_json(F.array_sort(F.collect_list(F.struct("path", "length", "modificationTime"))))).alias("h")).first())
    app = spark.conf.get("spark.app.id")
    key = (app, sf_dir, str(seen["h"]))
    if key not in _STORED or not spark.catalog.tableExists(_STORED[key]):
        prefix = unique_table("dispose")
        load_sales(spark, sf_dir, bucket_facts(spark, sf_dir, prefix), f"{prefix}_ventes")
        _STORED[key] = f"{prefix}_ventes"
    return spark.table(_STORED[key])
