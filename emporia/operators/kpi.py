"""Dashboard KPI shapes (operators 35-38): the publisher's and the chart
page's logic, re-expressed over all days at once.

Every input here is already aggregated per day or per (day, hour), so these
frames have at most 24 rows per day and KPI; the day list is broadcast when
AQE measures it small (it is: one row per day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporia.functions.labels import KPI_DAU_NAME, KPI_NEW_MID_NAME, KPI_ORDER_AMOUNT_NAME



def realtime_total(dau_total: DataFrame, new_mid: DataFrame, order_total: DataFrame) -> DataFrame:
    """Per day one row per KPI: ``dau``, ``new_mid``, ``order_amount`` with
    their display names; a KPI with no data that day is 0 (operator 35).

    Inputs: (dt, dau), (dt, new_mid), (dt, order_amount)."""
    long = (
        dau_total.select("dt", F.lit("dau").alias("id"), F.col("dau").cast("double").alias("value"))
        .unionByName(new_mid.select("dt", F.lit("new_mid").alias("id"), F.col("new_mid").cast("double").alias("value")))
        .unionByName(order_total.select("dt", F.lit("order_amount").alias("id"),
                                        F.col("order_amount").cast("double").alias("value")))
    )
    # each source once: the day's values side by side, then a row a KPI
    value = lambda k: F.coalesce(F.max(F.when(F.col("id") == k, F.col("value"))), F.lit(0.0))
    named = (("dau", KPI_DAU_NAME), ("new_mid", KPI_NEW_MID_NAME), ("order_amount", KPI_ORDER_AMOUNT_NAME))
    day = long.groupBy("dt").agg(*[value(k).alias(k) for k, _ in named])
    kpis = F.array(*[F.struct(F.lit(k).alias("id"), F.lit(name).alias("name"), F.col(k).alias("value")) for k, name in named])
    return day.select("dt", F.explode(kpis).alias("k")).select("dt", "k.id", "k.name", "k.value")


def hourly_long(dau_hour: DataFrame, order_hour: DataFrame) -> DataFrame:
    """(id, dt, hr 'HH', value) rows of both hourly series."""
    d = dau_hour.select(F.lit("dau").alias("id"), "dt", "hr", F.col("n").cast("double").alias("value"))
    o = order_hour.select(
        F.lit("order_amount").alias("id"), "dt", F.lpad(F.col("hr").cast("string"), 2, "0").alias("hr"),
        F.col("order_amount").cast("double").alias("value"),
    )
    return d.unionByName(o)


def today_vs_yesterday(hourly: DataFrame) -> DataFrame:
    """Per KPI, day and hour: today's value beside the same hour of the day
    before (operator 36).  Days are the days that have data; a side with no
    data is null (the dashboard draws it as missing)."""
    next_day = F.date_format(F.date_add(F.col("dt").cast("date"), 1), "yyyy-MM-dd")
    none = F.lit(None).cast("double")
    # a value is its own day's "today" and the next day's "yesterday"
    sides = F.array(
        F.struct(F.col("dt"), F.col("value").alias("today"), none.alias("yesterday"), F.lit(True).alias("own")),
        F.struct(next_day.alias("dt"), none.alias("today"), F.col("value").alias("yesterday"), F.lit(False).alias("own")),
    )
    both = hourly.select("id", "hr", F.explode(sides).alias("s")).groupBy("id", F.col("s.dt").alias("dt"), "hr").agg(
        F.max("s.today").alias("today"), F.max("s.yesterday").alias("yesterday"), F.max("s.own").alias("_own"))
    # a day has at most 24 rows a KPI here
    both = both.withColumn("_day", F.max("_own").over(Window.partitionBy("dt")))
    return both.where("_day").select("id", "dt", "hr", "today", "yesterday")


def hour_zero_fill(hourly: DataFrame) -> DataFrame:
    """Dense 00..23 axis per KPI and day, absent hours 0 (operator 37)."""
    hours = F.sequence(F.lit(0), F.lit(23))
    filled = hour_map(hourly).select("id", "dt", F.explode(F.transform(hours, lambda h: F.lpad(h.cast("string"), 2, "0"))).alias("hr"), "hours")
    return filled.select("id", "dt", "hr", F.coalesce(F.try_element_at("hours", F.col("hr")), F.lit(0.0)).alias("value"))


def hour_map(hourly: DataFrame) -> DataFrame:
    """One ``hr -> value`` map per KPI and day (operator 38); at most 24
    entries are collected per group."""
    return hourly.groupBy("id", "dt").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("hr", "value")))).alias("hours")
    )
