"""L2/L3: daily windows over an event-time stream.

Event time comes from the source as TIMESTAMP_NTZ; watermarks need
TIMESTAMP, so it is cast under a UTC session time zone (day windows are
UTC days).  Output mode is ``update``: with the watermark, state for
closed days is dropped, so state stays bounded on an endless stream.
Each micro-batch's changed rows are upserted by key into a table of one
row per day (or day and type): only the months that it touches are
rewritten, and a replayed batch is harmless.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.sinks.tables import MONTH, ensure_table, rows_of, upsert_kpis
from salesflow.streaming.arrivals import MAX_FILE_AGE


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str | None = None,
                fmt: str = "parquet", max_files_per_trigger: int | None = None,
                max_file_age: str = MAX_FILE_AGE) -> DataFrame:
    """A stream of the files of ``folder``, old ones included."""
    r = spark.readStream.schema(schema).format(fmt).option("maxFileAge", max_file_age)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(folder)


def _run_upsert(spark: SparkSession, agg: DataFrame, table: str, keys: Sequence[str],
                checkpoint: str) -> None:
    q = (agg.writeStream.outputMode("update")
         .foreachBatch(lambda b, _e: upsert_kpis(spark, b, table, list(keys)))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _needs_utc(spark: SparkSession) -> None:
    """Day windows are days of the session's time zone: it must be UTC."""
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z"):
        raise ValueError("set spark.sql.session.timeZone to UTC for daily streams")


def daily_kpi_stream(spark: SparkSession, stream: DataFrame, table: str, checkpoint: str,
                     ts: str = "ts", value: str = "value", delay: str = "1 day") -> DataFrame:
    """L2: per UTC day, number of events and Σvalue (2-digit decimals).
    Rows arriving up to ``delay`` behind the latest event time seen are
    guaranteed to count; later rows may be dropped (Spark's watermark
    contract), which is what bounds the state."""
    _needs_utc(spark)
    ensure_table(spark, table, "date string, nb_evenements bigint, valeur_totale double",
                 partition=MONTH)
    ev = stream.withColumn("_t", F.col(ts).cast("timestamp")).withWatermark("_t", delay)
    agg = (ev.groupBy(F.window("_t", "1 day").alias("w"))
           .agg(F.count(F.lit(1)).alias("nb_evenements"),
                F.sum(F.col(value).cast("decimal(18,2)")).cast("double").alias("valeur_totale"))
           .select(F.date_format("w.start", "yyyy-MM-dd").alias("date"),
                   "nb_evenements", "valeur_totale"))
    _run_upsert(spark, agg, table, ["date"], checkpoint)
    return rows_of(spark, table)


def event_counts_stream(spark: SparkSession, stream: DataFrame, table: str, checkpoint: str,
                        ts: str = "ts", kind: str = "event_type", delay: str = "1 day") -> DataFrame:
    """L3: events counted per UTC day and type."""
    _needs_utc(spark)
    ensure_table(spark, table, "date string, type_event string, nb bigint", partition=MONTH)
    ev = stream.withColumn("_t", F.col(ts).cast("timestamp")).withWatermark("_t", delay)
    agg = (ev.groupBy(F.window("_t", "1 day").alias("w"), F.col(kind).alias("type_event"))
           .agg(F.count(F.lit(1)).alias("nb"))
           .select(F.date_format("w.start", "yyyy-MM-dd").alias("date"), "type_event", "nb"))
    _run_upsert(spark, agg, table, ["date", "type_event"], checkpoint)
    return rows_of(spark, table)


def event_log_stream(spark: SparkSession, stream: DataFrame, target: str, checkpoint: str,
                     ts: str = "ts") -> DataFrame:
    """L3, the log itself: events appended as they come, one row each, by
    the file sink, whose commit log makes every micro-batch count once.
    Returns the log (date, time stamp, and the stream's columns)."""
    _needs_utc(spark)
    rows = stream.withColumn("date", F.date_format(F.col(ts), "yyyy-MM-dd"))
    q = (rows.writeStream.outputMode("append").format("parquet").option("path", target)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(rows.schema).parquet(target)
