"""File sinks.  Spark writes a folder of part files; nothing is funnelled
through one task to produce a single file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """B1: headered CSV, no index column, overwrite; quotes inside a cell
    are doubled."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def export_report(kpis: DataFrame, folder: str, ds: str, cols=None, key: str = "date",
                  month_only: bool = False) -> str:
    """KPI history, newest first, to ``rapport_mensuel_<yyyy-MM>``.
    As in the reference the content is every date (the file is keyed by
    month only); ``month_only=True`` keeps that month's dates."""
    out = kpis.select(*cols) if cols else kpis
    if month_only:
        out = out.where(F.substring(F.col(key), 1, 7) == ds[:7])
    path = f"{folder.rstrip('/')}/rapport_mensuel_{ds[:7]}"
    return write_csv(out.orderBy(F.desc(key)), path)
