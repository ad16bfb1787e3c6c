"""Table scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, name: str, date: str | Column | None = None,
         key: str = "date") -> DataFrame:
    """A4: a catalog table, whole or one date (a partition filter on
    date-partitioned tables: only that directory is listed and read)."""
    df = spark.table(name)
    return df if date is None else for_day(df, date, key)


def for_day(df: DataFrame, date: str | Column, key: str = "date") -> DataFrame:
    """Rows of one date."""
    d = date if isinstance(date, Column) else F.lit(date)
    return df.where(F.col(key) == d)
