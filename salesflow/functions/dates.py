"""Date keys.  Dates travel as ``yyyy-MM-dd`` text so lexical order is
date order and the value doubles as a partition directory name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesflow.functions._util import to_col


def day_key(ts: Column | str) -> Column:
    return F.date_format(to_col(ts), "yyyy-MM-dd")


def nodash_key(day: Column | str) -> Column:
    """``yyyy-MM-dd`` -> ``yyyyMMdd``."""
    return F.date_format(F.to_date(to_col(day)), "yyyyMMdd")


def month_key(day: Column | str) -> Column:
    """``yyyy-MM-dd`` -> ``yyyy-MM``."""
    return F.date_format(F.to_date(to_col(day)), "yyyy-MM")


def add_days(day: Column | str, n: int | Column) -> Column:
    """``day + n`` days, back as ``yyyy-MM-dd`` text."""
    return F.date_format(F.date_add(F.to_date(to_col(day)), n), "yyyy-MM-dd")
