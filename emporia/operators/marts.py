"""Aggregates over wide rows (operators 28-32).

Money is summed as ``decimal(18,2)`` (exact) and turned into ``double`` once
at the end.  Every aggregate here is algebraic, so Spark computes partial sums
on the map side and a hot key (one trademark with a third of the sales)
shuffles one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUM_MONEY = "decimal(18,2)"


def money_sum(col: str | Column, alias: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast(SUM_MONEY)).cast("double").alias(alias)


def trademark_batch(wide: DataFrame, stat_time: str | Column) -> DataFrame:
    """Per batch: paid amount by trademark name (operator 28); a null name is
    its own group.  ``stat_time`` is the batch time (a parameter in batch)."""
    st = F.lit(stat_time) if isinstance(stat_time, str) else stat_time
    return wide.groupBy(F.col("tm_name").alias("trademark_name")).agg(money_sum("final_detail_amount", "amount")).select(
        st.alias("stat_time"), "trademark_name", "amount"
    )


def trademark_day(wide: DataFrame) -> DataFrame:
    """Per day: paid amount by trademark (operator 29)."""
    return wide.groupBy("dt", F.col("tm_name").alias("trademark_name")).agg(
        money_sum("final_detail_amount", "amount")
    )


def order_amount_total(wide: DataFrame) -> DataFrame:
    """Daily ``sum(final_total_amount)`` over wide rows, as the reference
    writes it (order totals repeat on each line, D1) (operator 30)."""
    return wide.groupBy("dt").agg(money_sum("final_total_amount", "order_amount"))


def order_hour(create_time: Column) -> Column:
    """Hour of a ``yyyy-MM-dd HH:mm:ss`` text as a number (``toHour``)."""
    return F.hour(F.to_timestamp(create_time, "yyyy-MM-dd HH:mm:ss")).cast("long")


def order_amount_hour(wide: DataFrame) -> DataFrame:
    """Same, by hour of ``create_time`` (operator 31)."""
    return wide.groupBy("dt", order_hour(F.col("create_time")).alias("hr")).agg(
        money_sum("final_total_amount", "order_amount")
    )


def order_share_hour(wide: DataFrame) -> DataFrame:
    """Daily and hourly sums of the line shares, so an order counts once
    (operator 32).  ``hr`` is null on the day-total rows (a rollup with the
    day always present)."""
    hr = order_hour(F.col("create_time")).alias("hr")
    return wide.rollup("dt", hr).agg(
        money_sum("final_detail_amount", "order_amount"), F.grouping_id().alias("_g")
    ).where("_g < 3").drop("_g")
