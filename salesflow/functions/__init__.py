"""Column expressions (no UDFs): text keys, rounding, labels, dates."""

from salesflow.functions.dates import add_days, day_key, month_key, nodash_key
from salesflow.functions.labels import (
    bucket, status2, status_fixed, status_region, status_vs_target)
from salesflow.functions.numeric import (
    as_money, attainment, margin, ratio, round_even, round_half_up)
from salesflow.functions.text import code_key, ends_with, slug, starts_with, title_case

__all__ = [
    "add_days", "day_key", "month_key", "nodash_key",
    "bucket", "status2", "status_fixed", "status_region", "status_vs_target",
    "as_money", "attainment", "margin", "ratio", "round_even", "round_half_up",
    "code_key", "ends_with", "slug", "starts_with", "title_case",
]
