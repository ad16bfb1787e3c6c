"""Sinks and load semantics: tables, idempotent day loads, keyed KPI
upserts, event log, surrogate keys, CSV exports."""

from salesflow.sinks.tables import (
    MONTH, add_surrogate_key, append_by_name, append_with_ids, ensure_table, log_events, replace_day,
    replace_days, rows_of, upsert_frame, upsert_kpis)
from salesflow.sinks.files import export_report, write_csv

__all__ = ["MONTH", "add_surrogate_key", "append_by_name", "append_with_ids", "rows_of", "ensure_table", "log_events",
           "replace_day", "replace_days", "upsert_frame", "upsert_kpis",
           "export_report", "write_csv"]
