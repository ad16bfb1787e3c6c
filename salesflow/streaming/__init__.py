"""Structured Streaming versions of the daily jobs: file-arrival ingest,
daily KPI windows with a lateness bound, event counts."""

from salesflow.streaming.arrivals import inbox_changes, ingest_arrivals, sync_inbox
from salesflow.streaming.daily import daily_kpi_stream, event_counts_stream, event_log_stream, file_stream
from salesflow.streaming.late import late_events, whole_events_stream

__all__ = ["late_events", "whole_events_stream", "inbox_changes", "ingest_arrivals", "sync_inbox", "event_log_stream", "daily_kpi_stream", "event_counts_stream", "file_stream"]
