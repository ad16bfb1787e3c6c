"""Sources: CSV / JSON files, folders of daily files, tolerant path
lists, table scans, fallback sources, configuration frames."""

from salesflow.sources.files import (
    NA_VALUES, read_available, read_csv, read_files, read_json_records, read_many, unreadable_files)
from salesflow.sources.config import config_df, parse_config
from salesflow.sources.fallback import with_fallback
from salesflow.sources.tables import for_day, scan

__all__ = ["NA_VALUES", "read_available", "read_csv", "read_files", "read_json_records", "read_many",
           "unreadable_files",
           "config_df", "parse_config", "with_fallback", "for_day", "scan"]
