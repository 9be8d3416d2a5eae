"""Date helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def as_date(c: Column) -> Column:
    """Timestamp (with or without zone) or date -> date."""
    return c.cast("date")


def ts_day_range(ts_col: str, start: dt.date, end: dt.date) -> Column:
    """``CAST(ts AS DATE) BETWEEN start AND end`` written on the raw column.

    Comparing the timestamp itself keeps the predicate pushable to the
    Parquet reader (row-group skipping); a cast would hide it.
    """
    c = F.col(ts_col)
    lo = F.lit(start.isoformat()).cast("timestamp_ntz")
    hi = F.lit((end + dt.timedelta(days=1)).isoformat()).cast("timestamp_ntz")
    return (c >= lo) & (c < hi)


def inclusive_days(start: Column, end: Column) -> Column:
    """Calendar days from start to end, both included."""
    return F.datediff(end, start) + F.lit(1)
