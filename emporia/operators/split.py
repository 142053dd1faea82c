"""Paid amount split over order lines (operator 44).

Reference semantics, lines of an order taken in detail-id order, with
``o`` = line gross (price x num), ``T`` = order gross, ``F`` = order paid:

* a line whose running gross reaches ``T`` exactly (and that is not the
  order's first line) takes the remainder ``F - (shares of earlier lines)``;
* every other line takes ``round(F * o / T, 2)`` (HALF_UP);
* ``T = 0``: the first line takes ``F`` (its running total 0 equals T).

Plan.  When the lines add up to the gross total (``sum(o) = T``, the normal
case - the gross total *is* that sum), the completing line is simply the last
line with a non-zero gross, and its remainder is ``F - (sum(raw) - raw)``.
That needs only per-order aggregates, which Spark pre-aggregates on the map
side: no window, no group buffered in one task, and after the order-line join
(already hash-partitioned by order id) no further exchange.

Only orders whose lines do not add up to ``T`` need running sums.  These are
taken in two levels: an order's line ids are cut into ranges of about
``RANGE_LINES`` lines, sums run within each range, and the sums of whole ranges
(partial aggregates) run over the ranges before it.  So the lines of a hot
order spread over as many tasks as it has ranges.  The ranges are equal
stretches of ids between the order's least and greatest, exact for ids given
in sequence; where ids are bunched, so are the ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
SUM = "decimal(28,2)"
RANGE_LINES = 50_000


def _raw_share(final_total, gross, total):
    return F.round(final_total * gross / total, 2).cast(MONEY)


def order_stats(lines: DataFrame) -> DataFrame:
    """Per-order aggregates of lines with ``order_id``, ``order_detail_id``,
    ``_o`` (gross) and ``_raw`` (rounded share): partial-aggregated per task."""
    return lines.groupBy(F.col("order_id").alias("_sid")).agg(
        F.sum("_o").alias("_sum_o"),
        F.min("_o").alias("_min_o"),
        F.sum("_raw").alias("_sum_raw"),
        F.count("order_detail_id").alias("_n_lines"),
        F.min("order_detail_id").alias("_first_id"),
        F.max("order_detail_id").alias("_last_id"),
        F.max(F.when(F.col("_o") != 0, F.col("order_detail_id"))).alias("_last_pos_id"),
    )


def narrow_stats(order_detail: DataFrame, order_info: DataFrame) -> DataFrame:
    """``order_stats`` from the narrow source tables (line id, order id, price,
    quantity; order id, paid and gross totals) instead of the wide rows, so the
    statistics do not re-run the dimension joins of the wide row.  Valid when
    the wide rows are exactly the inner join of these lines and orders (the
    dimension joins are left joins on unique keys)."""
    d = order_detail.select(
        F.col("id").alias("order_detail_id"), "order_id",
        (F.col("order_price") * F.col("sku_num")).cast(MONEY).alias("_o"),
    )
    o = order_info.select(
        F.col("id").alias("_oid"), F.col("final_total_amount").alias("_F"), F.col("original_total_amount").alias("_T"),
    )
    j = d.join(o, d["order_id"] == o["_oid"])
    lines = j.select(
        "order_id", "order_detail_id", "_o",
        F.when(F.col("_T") != 0, _raw_share(F.col("_F"), F.col("_o"), F.col("_T"))).alias("_raw"),
    )
    return order_stats(lines)


def amount_split(wide: DataFrame, stats: DataFrame | None = None, range_lines: int = RANGE_LINES) -> DataFrame:
    """Fill ``final_detail_amount`` of wide rows (columns of
    ``orders.ORDER_WIDE_COLUMNS``, money as ``decimal(12,2)``).  ``stats``
    (``order_stats``/``narrow_stats``) may be given; by default it is
    aggregated from ``wide`` itself.  ``range_lines``: lines of an order that
    one task sums up where running sums are needed."""
    cols = wide.columns
    o = (F.col("sku_price") * F.col("sku_num")).cast(MONEY)
    T = F.col("original_total_amount")
    Fp = F.col("final_total_amount")
    lines = (
        wide.withColumn("_o", o)
        .withColumn("_raw", F.when(T != 0, _raw_share(Fp, F.col("_o"), T)))
    )
    if stats is None:
        stats = order_stats(lines)
    j = lines.join(stats, lines["order_id"] == stats["_sid"], "inner")
    # One flag over both join sides decides the path.  Being a single
    # expression over both sides, no part of it is pushed below the join, so
    # the two branches below keep identical subtrees and share their shuffles
    # (ReusedExchange) instead of re-running the upstream joins.
    j = j.withColumn("_closed", F.when(T == 0, F.lit(True)).otherwise(F.coalesce((F.col("_sum_o") == T) & (F.col("_min_o") >= 0), F.lit(False))))
    did = F.col("order_detail_id")

    # T = 0: the first line's running total 0 equals T, so it takes F; a later
    # line with zero gross takes F - F = 0; any other line divides by zero in
    # the reference (null here).
    zero_total = (
        F.when(did == F.col("_first_id"), Fp)
        .when(F.col("_o") == 0, F.lit(0).cast(MONEY))
    )
    closed_form = (
        F.when(T == 0, zero_total)
        .when((did == F.col("_last_pos_id")) & (did != F.col("_first_id")),
              (Fp - (F.col("_sum_raw") - F.col("_raw"))).cast(MONEY))
        .otherwise(F.col("_raw"))
    )
    easy = j.where(F.col("_closed")).withColumn("final_detail_amount", closed_form.cast(MONEY))

    hard = running_split(j.where(~F.col("_closed")), range_lines)
    return easy.select(*cols).unionByName(hard.select(*cols))


def _ranged_sums(lines: DataFrame, sums: dict[str, str]) -> DataFrame:
    """``lines`` with running sums ``{new column: summed column}`` within each
    order by line id, up to and including the line: within a range by a window
    of (order, range), plus the sums of the order's earlier ranges."""
    inside = Window.partitionBy("order_id", "_range").orderBy("order_detail_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = lines.groupBy(F.col("order_id").alias("_rid"), F.col("_range").alias("_rr")).agg(*[F.sum(c).alias(f"{n}_all") for n, c in sums.items()])
    # one row a range
    earlier = Window.partitionBy("_rid").orderBy("_rr").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(SUM)
    before = whole.select("_rid", "_rr", *[F.coalesce(F.sum(f"{n}_all").over(earlier), zero).cast(SUM).alias(f"{n}_before") for n in sums])
    run = lines.select("*", *[F.coalesce(F.sum(c).over(inside), zero).cast(SUM).alias(f"{n}_in") for n, c in sums.items()])
    run = run.join(before, (F.col("order_id") == F.col("_rid")) & (F.col("_range") == F.col("_rr")))
    return run.select(*lines.columns, *[(F.col(f"{n}_in") + F.col(f"{n}_before")).cast(SUM).alias(n) for n in sums])


def running_split(lines: DataFrame, range_lines: int = RANGE_LINES) -> DataFrame:
    """``final_detail_amount`` of orders whose lines don't add up to their
    total, by running sums.  ``lines`` carry their order's ``order_stats``.

    A line that completes ``T`` takes what is left of ``F``; after it the
    shares add up to ``F``, so a later completing line only undoes the rounded
    shares in between.  Lines of zero gross leave every sum as it is."""
    n_ranges = F.floor((F.col("_n_lines") - 1) / range_lines) + 1
    width = F.greatest(F.lit(1), F.ceil((F.col("_last_id") - F.col("_first_id") + 1) / n_ranges)).cast("long")
    lines = lines.withColumn("_width", width).withColumn("_range", F.coalesce(F.expr("(order_detail_id - _first_id) div _width"), F.lit(0)))
    run = _ranged_sums(lines.withColumn("_given", F.coalesce(F.col("_raw"), F.lit(0).cast(MONEY))), {"_run": "_o", "_paid": "_given"})
    T, Fp, did = F.col("original_total_amount"), F.col("final_total_amount"), F.col("order_detail_id")
    run = run.withColumn("_done", F.coalesce((did != F.col("_first_id")) & (F.col("_run") == T) & (F.col("_o") != 0), F.lit(False)))
    # what was paid up to each completing line; only orders with lines of negative gross have several
    done = run.where(F.col("_done") & (F.col("_min_o") < 0)).select(F.col("order_id").alias("_did_order"), did.alias("_did"), F.col("_paid").alias("_did_paid"))
    last = F.lag("_did_paid").over(Window.partitionBy("_did_order").orderBy("_did"))
    done = done.select("_did_order", "_did", last.alias("_last_paid"))
    run = run.join(done, (F.col("order_id") == F.col("_did_order")) & (did == F.col("_did")), "left")
    earlier = F.col("_paid") - F.col("_given")
    left = F.when(F.col("_last_paid").isNull(), Fp - earlier).otherwise(F.col("_last_paid") - earlier)
    return run.withColumn("final_detail_amount", F.when(F.col("_done"), left.cast(MONEY)).otherwise(F.col("_raw")))
