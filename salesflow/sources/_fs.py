"""Path checks with the public reader API (works for any file system the
session is configured for, and under Spark Connect).  Listing happens
when the reader resolves the paths; no file content is read."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException:
        return False


def any_file(spark: SparkSession, folder: str, glob: str, recursive: bool = True) -> bool:
    """Whether ``folder`` holds a file whose name matches ``glob``."""
    if not exists(spark, folder):
        return False
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", str(recursive).lower()).load(folder))
    return files.select(F.col("path")).limit(1).count() > 0
