"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesflow.functions._util import to_col


def title_case(c: Column | str) -> Column:
    """Python ``str.title``: upper-case the first letter of every run of
    letters, lower-case the rest (``jean-pierre o'neil 3rd`` ->
    ``Jean-Pierre O'Neil 3Rd``).  ``initcap`` only splits on spaces."""
    runs = F.regexp_extract_all(to_col(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    cased = F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)),
                                                  F.lower(F.substring(x, 2, 1 << 30))))
    return F.array_join(cased, "")


def code_key(c: Column | str, n: int = 3) -> Column:
    """Short file key: first ``n`` characters, lower case, ``î`` -> ``i``."""
    return F.replace(F.lower(F.substring(to_col(c), 1, n)), F.lit("î"), F.lit("i"))


def slug(c: Column | str) -> Column:
    """File-name slug: lower case, spaces -> underscores."""
    return F.replace(F.lower(to_col(c)), F.lit(" "), F.lit("_"))


def starts_with(c: Column | str, prefix: str) -> Column:
    return F.startswith(to_col(c), F.lit(prefix))


def ends_with(c: Column | str, suffix: str) -> Column:
    return F.endswith(to_col(c), F.lit(suffix))
