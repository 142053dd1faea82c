"""Daily active devices (operators 33, 34, 39, 47 in batch form).

First visit per (day, device): the reference keeps the first record that
reaches its Redis set.  Here the first is the least record of the day in
``FIRST_ORDER``: the earliest ``ts``, then by its other fields, so that batch,
stream and sink agree whatever the order of arrival.  It is computed with
``min`` - an aggregate, so each map task keeps one candidate per (day, device)
before the shuffle and a device that sends a third of all logs costs no more
than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAU_COLUMNS = ["mid", "uid", "ar", "ch", "vc", "dt", "hr", "mi", "ts"]


# The order that tells which of a device's records of a day is the first; nulls come before values.
FIRST_ORDER = ["ts", "ch", "uid", "ar", "vc", "hr", "mi"]


def first_of_group() -> Column:
    """The first record of a group, as a struct of the fields other than day and device."""
    return F.min(F.struct(*FIRST_ORDER))


def first_visit(dau_rows: DataFrame) -> DataFrame:
    """One DAU document per (dt, mid): the first record of that day."""
    best = dau_rows.groupBy("dt", "mid").agg(first_of_group().alias("_doc"))
    return best.select("dt", "mid", "_doc.*").select(*DAU_COLUMNS)


def dau_total(dau: DataFrame) -> DataFrame:
    """Number of first visits per day (operator 33)."""
    return dau.groupBy("dt").agg(F.count(F.lit(1)).alias("dau"))


def dau_hour(dau: DataFrame) -> DataFrame:
    """First visits per (day, hour); the reference asks for the 24 largest hour
    buckets of a day, which are all there are (operator 34)."""
    return dau.groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("n"))


def new_devices(dau: DataFrame) -> DataFrame:
    """Devices whose first day is ``dt``, counted per day (operator 39; the
    reference returns the constant 233)."""
    first = dau.groupBy("mid").agg(F.min("dt").alias("dt"))
    return first.groupBy("dt").agg(F.count(F.lit(1)).alias("new_mid"))
