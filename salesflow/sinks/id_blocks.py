"""B7 without a global sort and without a race: ids in reserved blocks.

A load counts its rows and claims a block of that many ids from a log, one
small file a claim, numbered.  A claim is a rename that fails if the
number is taken (atomic on HDFS and local file systems, not on plain
object stores): the later of two loads at once sees the conflict, reads
the log again and claims the next block.  Ids are never given out twice;
a block whose load dies before its rows are written is used when that
load runs again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from salesflow.sinks.tables import replace_partitions

_ENTRY = "numero bigint, premier bigint, nombre bigint, parties int, cible string, lot string"


def _entries(spark: SparkSession, log: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(log)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return spark.read.schema(_ENTRY).json(log)


def _claim(spark: SparkSession, log: str, entry: dict) -> bool:
    """Write ``entry`` under its number; False if the number is taken."""
    fs_api = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    draft = fs_api.Path(f"{log}/_{uuid.uuid4().hex}")
    out = draft.getFileSystem(conf).create(draft, False)
    out.write((json.dumps(entry) + "\n").encode())
    out.close()
    rename = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE
    context = fs_api.FileContext.getFileContext(draft.toUri(), conf) if draft.toUri().getScheme() \
        else fs_api.FileContext.getFileContext(conf)
    try:
        context.rename(draft, fs_api.Path(f"{log}/{entry['numero']:015d}.json"), how)
    except Py4JJavaError as e:
        context.delete(draft, False)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def _latest(spark: SparkSession, log: str, target: str, lot: str) -> Row | None:
    """The last claim of a load."""
    mine = _entries(spark, log).where((F.col("cible") == target) & (F.col("lot") == lot))
    return mine.orderBy(F.col("numero").desc()).first()


def reserve_ids(spark: SparkSession, log: str, target: str, lot: str, count: int, parts: int) -> int:
    """The first id of a block of ``count`` for load ``lot`` of ``target``; the
    block that it has already, if that fits."""
    held = _latest(spark, log, target, lot)
    if held is not None and (held.nombre, held.parties) == (count, parts):
        return held.premier
    while True:
        every = _entries(spark, log)
        last = every.agg(F.coalesce(F.max("numero"), F.lit(0)).alias("n")).first()["n"]
        top = every.where(F.col("cible") == target).agg(F.coalesce(F.max(F.expr("premier + nombre")), F.lit(1)).alias("n")).first()["n"]
        if _claim(spark, log, {"numero": last + 1, "premier": top, "nombre": count, "parties": parts, "cible": target, "lot": lot}):
            return top


def append_with_id_blocks(spark: SparkSession, df: DataFrame, table: str, order: Sequence[str], log: str, lot: str,
                          col: str = "id") -> None:
    """Load ``df`` as ``lot`` into ``table`` (partitioned by ``lot``) with ids that
    no other load has.

    ``order`` names columns that tell rows apart: rows are spread by their hash
    and sorted in their partition only, the frame is checkpointed once, and a
    row's id is the block's first, plus the rows of the partitions before, plus
    its place.  The same lot again replaces its rows and, if they are the same,
    gives the same ids (the number of partitions is part of the claim); a lot
    with another number of rows gets a new block."""
    held = _latest(spark, log, table, lot)
    parts = held.parties if held is not None else int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartition(parts, *order).sortWithinPartitions(*order) \
        .withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()).checkpoint()
    counts = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    total = counts.agg(F.coalesce(F.sum("_cnt"), F.lit(0)).alias("n")).first()["n"]
    first = reserve_ids(spark, log, table, lot, total, parts) if total else 0
    offsets = counts.select("_pid", (F.sum("_cnt").over(Window.orderBy("_pid")) - F.col("_cnt")).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    rows = placed.join(F.broadcast(offsets), "_pid").withColumn(col, F.lit(first) + F.col("_off") + local) \
        .drop("_pid", "_mid", "_off").withColumn("lot", F.lit(lot))
    replace_partitions(spark, rows, table, [lot], "lot")
