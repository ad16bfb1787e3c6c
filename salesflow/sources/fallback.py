"""Primary source with a backup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FALLBACK = "FALLBACK"


def with_fallback(primary: DataFrame, backup: DataFrame, key: str | Sequence[str] = "date",
                  source: str = "source", label: str = FALLBACK) -> DataFrame:
    """Rows of ``primary``, plus ``backup`` rows for every key the
    primary lacks, tagged ``source = 'FALLBACK'``.

    The covered keys are a distinct projection of the primary (one row
    per key), anti-joined to the backup: a shuffle on the key, no
    broadcast (the key set grows with the history)."""
    keys = [key] if isinstance(key, str) else list(key)
    covered = primary.select(*keys).distinct()
    missing = backup.join(covered, keys, "left_anti").withColumn(source, F.lit(label))
    return primary.unionByName(missing, allowMissingColumns=True)
