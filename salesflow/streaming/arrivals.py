"""Pick up newly arrived files once, replay-safe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.sources.files import read_files, same_path, to_open

#: Files older than this against the newest are not looked for: beyond any
#: backfill (Spark's own default, a week, loses late exports).
MAX_FILE_AGE = "36500d"


def ingest_arrivals(spark: SparkSession, inbox: str, schema: T.StructType | str, target: str,
                    checkpoint: str, file_glob: str | None = None,
                    max_files_per_trigger: int | None = None, fmt: str = "csv",
                    max_file_age: str = MAX_FILE_AGE) -> DataFrame:
    """Ingest every file that arrived in ``inbox`` since the last run.

    The file source records processed files in ``checkpoint``, so a file
    is taken once.  Each micro-batch is written to ``target/batch=<id>``
    with overwrite: when a batch is replayed after a failure (same epoch
    id), it replaces its own output, so the target holds each file's rows
    exactly once.  A day split over several batches is whole in the
    union.  A file's age (modification time behind the newest file's) does
    not matter up to ``max_file_age``.  CSV files have their columns in any
    order; a header without a column of the schema is an error.  ``availableNow`` processes what is there and stops (the
    sensor's wait becomes a scheduled trigger).  Returns the target.
    """
    # CSV files are found as text and then read each by its own header
    reader = spark.readStream.option("maxFileAge", max_file_age)
    if fmt != "csv":
        reader = reader.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.format("text" if fmt == "csv" else fmt).load(inbox).withColumn("_file", F.col("_metadata.file_path"))

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        if fmt == "csv":
            names = [to_open(r["_file"]) for r in batch.select("_file").distinct().toLocalIterator()]  # those of one trigger
            if not names:
                return
            batch = read_files(spark, names, schema)
        batch.write.mode("overwrite").parquet(f"{target}/batch={epoch_id}")

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(_with_file(schema)).parquet(target) \
        if _has_output(spark, target) else spark.createDataFrame([], _with_file(schema))


def _with_file(schema: T.StructType | str) -> T.StructType:
    from salesflow.sources.config import ddl_schema
    st = ddl_schema(schema)
    return T.StructType(list(st.fields) + [T.StructField("_file", T.StringType())])


def _has_output(spark: SparkSession, target: str) -> bool:
    from salesflow.sources._fs import exists
    return exists(spark, target)


MANIFEST_DDL = "fichier string, taille bigint, modifie timestamp, etat string, version bigint"


def inbox_changes(spark: SparkSession, inbox: str, manifest: str, file_glob: str = "*.csv") -> DataFrame:
    """What changed in ``inbox`` since the last sync: ``fichier``, ``taille``,
    ``modifie``, ``etat`` (``nouveau``, ``modifie`` or ``retire``).

    A full outer comparison of the listing with the manifest's last version of
    each file.  A withdrawn file leaves a tombstone in the manifest: it is
    reported once, and is new if it comes back."""
    there = (spark.read.format("binaryFile").option("pathGlobFilter", file_glob)
             .option("recursiveFileLookup", "true").load(inbox)
             .select(same_path(F.col("_metadata.file_path")).alias("fichier"), F.col("length").alias("taille"),
                     F.col("modificationTime").alias("modifie")))
    known = (spark.table(manifest).groupBy("fichier")
             .agg(F.max_by(F.struct("taille", "modifie", "etat"), "version").alias("k"))
             .where("k.etat <> 'retire'"))
    state = (F.when(F.col("k").isNull(), "nouveau").when(F.col("taille").isNull(), "retire")
             .when((F.col("taille") != F.col("k.taille")) | (F.col("modifie") != F.col("k.modifie")), "modifie"))
    return (there.join(known, "fichier", "full_outer")
            .select("fichier", F.coalesce("taille", "k.taille").alias("taille"),
                    F.coalesce("modifie", "k.modifie").alias("modifie"), state.alias("etat"))
            .where("etat is not null"))


def sync_inbox(spark: SparkSession, inbox: str, schema: T.StructType | str, raw: str, manifest: str,
               daily: str, rebuild, file_glob: str = "*.csv", key: str = "date") -> DataFrame:
    """L1 at file grain: bring ``raw`` in line with the inbox, then rebuild
    the days that changed.

    A file that is new or differs from the ``manifest`` (made if absent) is read
    by its own header and replaces its partition (``fichier``) of ``raw``; one
    that was corrected to no rows, or withdrawn, has its partition cleared.  Days
    touched before or after the change are recomputed by ``rebuild(rows)`` from
    the rows of all files and replaced in ``daily`` (B4), cleared if no row is
    left.

    A crash at any point is made good by the next sync: the touched days are
    noted in ``<manifest>_jours`` before ``raw`` changes, and the manifest is
    written last, so until then the same files are taken again and the noted
    days rebuilt.  The paths of changed files pass through the driver, as those
    of every read do.  Returns the touched days."""
    from salesflow.session import scratch_path
    from salesflow.sinks.tables import append_by_name, ensure_table, replace_days, replace_partitions
    from salesflow.sources.config import ddl_schema
    cols = ddl_schema(schema)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cols.fields)
    noted = f"{manifest}_jours"
    ensure_table(spark, raw, f"{ddl}, fichier string", partition="fichier")
    ensure_table(spark, manifest, MANIFEST_DDL, partition=None)
    ensure_table(spark, noted, "jour string, version bigint", partition=None)
    path = scratch_path(spark, "inbox-changes")
    inbox_changes(spark, inbox, manifest, file_glob).write.parquet(path)
    changes = spark.read.parquet(path)
    names = {r["fichier"]: r["etat"] for r in changes.select("fichier", "etat").toLocalIterator()}
    done = spark.table(manifest).agg(F.coalesce(F.max("version"), F.lit(0)).alias("v")).first()["v"]
    left_over = spark.table(noted).where(F.col("version") > done).select(F.col("jour").alias(key))
    if not names and left_over.isEmpty():
        return spark.createDataFrame([], f"{key} string")
    to_read = sorted(to_open(n) for n, state in names.items() if state != "retire")
    if to_read:
        new = read_files(spark, to_read, cols).withColumn("fichier", same_path(F.col("_file"))).drop("_file")
    else:
        new = spark.createDataFrame([], spark.table(raw).schema)
    before = spark.table(raw).join(changes.select("fichier"), "fichier", "left_semi").select(key)
    touched_path = scratch_path(spark, "inbox-days")
    before.union(new.select(key)).union(left_over).distinct().write.parquet(touched_path)
    touched = spark.read.parquet(touched_path)
    version = F.lit(done + 1).cast("bigint").alias("version")
    append_by_name(spark, touched.select(F.col(key).cast("string").alias("jour"), version), noted)
    if names:
        replace_partitions(spark, new, raw, list(names), "fichier")
    rows = spark.table(raw).join(touched, key, "left_semi")
    days = [r[0] for r in touched.where(F.col(key).isNotNull()).toLocalIterator()]  # bounded by the calendar
    replace_days(spark, rebuild(rows), daily, days=days, key=key)
    closing = changes.select("fichier", "taille", "modifie", "etat", version)
    if not names:  # only days left over: a version without files closes them
        closing = spark.createDataFrame([("", 0, None, "retire", done + 1)], MANIFEST_DDL)
    append_by_name(spark, closing, manifest)
    return touched
