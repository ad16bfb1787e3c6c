"""Small helpers of the operators: shared tables, clash-free columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.session import scratch_path


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the folder ``spark.checkpoint.dir`` names
    and read it back: the lineage is cut by files that every executor sees,
    so a lost executor costs no recomputation of what came before."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_GIVEN: list = []


def given(spark, value):
    """Broadcast a value of proven size bound, to be let go by ``release``."""
    _GIVEN.append(spark.sparkContext.broadcast(value))
    return _GIVEN[-1]


def release() -> None:
    """Take what ``given`` has sent out of the executors' memory (a plan that
    still needs it fetches it again).  The pipeline does so before each stage,
    when the stage before it is written."""
    while _GIVEN:
        _GIVEN.pop().unpersist()


def documents(spark, sf_dir: str, columns=("doc_id", "text")) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null ids count as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n
