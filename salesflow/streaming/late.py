"""L2/L3 without lost or doubled events: the stream, and what it leaves out.

Spark's state drops an event that comes twice and one that comes behind
the watermark; that bounds the state.  Three folders keep the sum whole:

* ``recus``: every event as it came (a stateless stream);
* ``comptes``: the events that the state let through, each id once;
* ``tardifs``: events received and not counted, each id once (a batch
  step after the streams, over what came since the step before).

Days are summed from ``comptes`` and ``tardifs``, only those that the new
events touch, closed ones included.  Every folder is written by
micro-batch with overwrite (``batch=<number>/date=<day>``), so a replay
replaces its own output.  An id belongs to one event and one day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.sinks.tables import MONTH, append_by_name, ensure_table, rows_of, upsert_kpis
from salesflow.streaming.daily import _needs_utc

_PARTS = [T.StructField("batch", T.LongType()), T.StructField("date", T.StringType())]


def _write(rows: DataFrame, path: str, batch: int) -> None:
    """Overwrite one micro-batch; its days become folders of few files."""
    (rows.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("date").parquet(f"{path}/batch={batch}"))


def _run(stream: DataFrame, path: str, checkpoint: str) -> None:
    q = (stream.writeStream.outputMode("append").foreachBatch(lambda rows, n: _write(rows, path, n))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows under ``path`` with their batch and day; none before the first write."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    full = T.StructType([f for f in schema.fields if f.name != "date"] + _PARTS)
    if not fs.exists(folder):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(path)


def whole_events_stream(spark: SparkSession, stream: DataFrame, folder: str, table: str, key: str = "event_id",
                        ts: str = "ts", value: str = "value", delay: str = "1 day") -> DataFrame:
    """Take what has arrived, then bring the touched days of ``table`` (a row a
    day: ``date``, ``nb_evenements``, ``valeur_totale``, ``nb_tardifs``) up to date.

    ``folder`` holds the three layers, the streams' checkpoints and nothing else.
    Call it again with the same ``folder`` for what comes next, or after a crash:
    what was done is not done twice.  The columns ``batch``, ``date`` and ``_t``
    are its own; events without an id or a time are kept in ``recus`` only."""
    _needs_utc(spark)
    if clash := {"batch", "date", "_t"} & set(stream.columns):
        raise ValueError(f"columns of other meaning here: {sorted(clash)}")
    ensure_table(spark, table, "date string, nb_evenements bigint, valeur_totale double, nb_tardifs bigint", partition=MONTH)
    marks = ensure_table(spark, f"{table}_lots", "batch bigint", partition=None)
    dated = stream.withColumn("date", F.date_format(ts, "yyyy-MM-dd"))
    schema = dated.schema
    _run(dated, f"{folder}/recus", f"{folder}/ckpt-recus")
    once = (dated.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withColumn("_t", F.col(ts).cast("timestamp"))
            .withWatermark("_t", delay).dropDuplicatesWithinWatermark([key]).drop("_t"))
    _run(once, f"{folder}/comptes", f"{folder}/ckpt-comptes")

    last = spark.table(marks).agg(F.coalesce(F.max("batch"), F.lit(-1)).alias("n")).first()["n"]
    new = _read(spark, f"{folder}/recus", schema).where((F.col("batch") > last) & F.col(key).isNotNull() & F.col(ts).isNotNull())
    top = new.agg(F.max("batch").alias("n")).first()["n"]
    if top is None:
        return rows_of(spark, table)
    known = _known(spark, folder, schema, top).select(key, "date")
    late = new.drop("batch").dropDuplicates([key]).join(known, [key, "date"], "left_anti")
    _write(late, f"{folder}/tardifs", top)
    touched = new.select("date").distinct()
    events = _known(spark, folder, schema, top + 1).join(touched, "date", "left_semi")
    upsert_kpis(spark, events.groupBy("date").agg(
        F.count(F.lit(1)).alias("nb_evenements"), F.sum(F.col(value).cast("decimal(18,2)")).cast("double").alias("valeur_totale"),
        F.count_if("_late").alias("nb_tardifs")), table)
    append_by_name(spark, spark.createDataFrame([(top,)], "batch bigint"), marks)
    return rows_of(spark, table)


def _known(spark: SparkSession, folder: str, schema: T.StructType, below: int) -> DataFrame:
    """Events that count: let through by the state, or found late by a step
    under ``below``."""
    counted = _read(spark, f"{folder}/comptes", schema).withColumn("_late", F.lit(False))
    late = _read(spark, f"{folder}/tardifs", schema).where(F.col("batch") < below).withColumn("_late", F.lit(True))
    return counted.unionByName(late)


def late_events(spark: SparkSession, stream_schema: T.StructType, folder: str) -> DataFrame:
    """The side table: events that came behind the watermark, each once."""
    return _read(spark, f"{folder}/tardifs", stream_schema)
