"""Date and hour columns, all as text like the reference's beans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATETIME_FMT = "yyyy-MM-dd HH:mm:ss"


def dt_from_millis(ms: Column) -> Column:
    """epoch milliseconds -> ``yyyy-MM-dd`` in the session zone."""
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd")


def hr_from_millis(ms: Column) -> Column:
    """epoch milliseconds -> two-digit hour ``HH``."""
    return F.date_format(F.timestamp_millis(ms), "HH")


def date_part_of(create_time: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> its date text (the part before the space)."""
    return F.split(create_time, " ").getItem(0)


def hour_part_of(create_time: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> its hour text (``HH``)."""
    return F.split(F.split(create_time, " ").getItem(1), ":").getItem(0)


def as_text(ts: Column) -> Column:
    return F.date_format(ts, DATETIME_FMT)


def parse_text(text: Column) -> Column:
    return F.to_timestamp(text, DATETIME_FMT)
