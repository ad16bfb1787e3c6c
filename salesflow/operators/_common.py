from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

By = str | Sequence[str] | None


def by_list(by: By) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def group(df: DataFrame, by: By):
    keys = by_list(by)
    return df.groupBy(*keys) if keys else df.groupBy()


def top_order(total: Column, key: Column) -> Column:
    """Ordering for ``min_by``: largest total first, ties -> smallest key,
    null keys after every non-null key."""
    return F.struct((-F.coalesce(total, F.lit(0))).alias("neg_total"),
                    key.isNull().alias("key_null"), key.alias("key"))
