"""DataFrame -> DataFrame operators.  All group by a date column (or any
key list passed as ``by``), so one job covers a whole history."""
