"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by digest, one row per known text:
``digest`` (SHA-256), ``keep_id``.  New rows are digested, grouped by digest
(partial aggregation, so a digest that a third of all rows share is one row
per task), joined with the index by sort-merge anti-join, and what is new is
appended.  The text itself is never shuffled and never stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm._shared import ascii_lower, shared_table


def digest(text) -> F.Column:
    """SHA-256 of the text after A-Z became a-z; null counts as empty."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256))


class DigestIndex:
    """A digest index in the catalog table ``table``, made if absent.

    ``buckets`` should be of the order of the shuffle partitions of a load: a
    load groups by digest into that many partitions and each task appends one
    sorted file to its bucket, with no further shuffle of new or known rows.
    """

    def __init__(self, spark: SparkSession, table: str, buckets: int | None = None):
        self.spark, self.table = spark, table
        if spark.catalog.tableExists(table):  # it keeps the buckets that it was made with
            made = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'").first()
            self.buckets = int(made["data_type"])
        else:
            self.buckets = buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
            self._save(spark.createDataFrame([], "digest binary, keep_id bigint"))

    def _save(self, rows: DataFrame) -> None:
        (rows.write.mode("append").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table))

    def known(self) -> DataFrame:
        return self.spark.table(self.table)

    def load(self, rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Decide on ``rows``, append what is new, return one row per input
        row: ``id_col``, ``keep_id``, ``group_size``, ``kept``, ``digest``.

        The row that stays is the one the index already names, else the one
        with the largest id among equal texts of this load (a null id only
        stays if no equal text has an id).  ``group_size`` counts the rows of
        this load with that text.  Equal rows with one id are all kept or all
        dropped; null text counts as empty; an empty load appends nothing.
        Running a load again drops nothing new and appends nothing.
        """
        mine = shared_table(
            rows.select(F.col(id_col).cast("bigint").alias("_id"), digest(F.col(text_col)).alias("digest")),
            "digests")
        groups = shared_table(
            mine.groupBy("digest").agg(F.max("_id").alias("last_id"), F.count(F.lit(1)).alias("group_size")),
            "groups")
        known = self.known()
        fresh = (groups.repartition(self.buckets, "digest")
                 .join(known.hint("merge"), "digest", "left_anti")
                 .select("digest", F.col("last_id").alias("keep_id")))
        old = groups.join(known.select("digest", F.col("keep_id").alias("known_id"),
                                       F.lit(True).alias("seen")).hint("merge"), "digest", "left")
        decided = shared_table(
            old.select("digest", "group_size", F.coalesce("seen", F.lit(False)).alias("seen"),
                       F.when(F.col("seen"), F.col("known_id")).otherwise(F.col("last_id")).alias("keep_id")),
            "decided")
        self._save(fresh)
        out = mine.join(decided, "digest")
        return out.select(
            F.col("_id").alias(id_col), "keep_id", "group_size",
            (F.col("_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "digest")
