"""salesflow: daily sales analytics on Spark DataFrames.

Sources read files and tables, operators transform DataFrames (quality
checks, enrichment, KPIs, reports, consolidation, monitoring), sinks load
date-partitioned tables idempotently, and streaming wraps the same
operators in Structured Streaming queries.  Every operator works on many
dates at once: the date is a grouping key, never a driver-side loop.
"""

__version__ = "0.1.0"
