"""Serving-side operators (operators 5, 15, 40-43): document search, paged
detail search with totals, buyer shares, province sales, chart points.

A day may hold a large share of all rows, so a page of it is located by counts
of key ranges and no day is ever sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.operators.marts import money_sum

#: Ranges of keys that are counted per group to find a page's place, in each of two steps.
PAGE_RANGES = 4096


def token_match(text: Column, term: str) -> Column:
    """Analysed-text match: lower-case, split on what is neither a
    letter nor a digit of any script, look
    for the (lower-cased) term among the tokens."""
    return F.array_contains(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), term.lower())


def search_docs(docs: DataFrame, text_col: str, term: str, range_col: str, lo, hi) -> DataFrame:
    """Range filter AND term match (the reference's bool query)."""
    return docs.where(F.col(range_col).between(lo, hi) & token_match(F.col(text_col), term))


def _located(rows: DataFrame, group: str, key: str, lo: str, hi: str, first: int, last: int, before: str) -> DataFrame:
    """The rows of the key ranges that hold the places ``first..last`` of each
    group, of rows whose keys lie in ``lo..hi`` and whose first row has
    ``before`` rows of its group before it.  Ranges are counted, not sorted:
    one row a (group, range) is left before any window."""
    width = F.greatest(F.lit(1), F.ceil((F.col(hi) - F.col(lo) + 1) / PAGE_RANGES)).cast("long")
    cut = rows.withColumn("_w", width).withColumn("_r", F.expr(f"({key} - {lo}) div _w"))
    counts = cut.groupBy(F.col(group).alias("_g"), F.col("_r").alias("_gr")).agg(
        F.count(F.lit(1)).alias("_n"), F.first(before).alias("_b"), F.min(key).alias("_min"), F.max(key).alias("_max"))
    upto = F.col("_b") + F.sum("_n").over(Window.partitionBy("_g").orderBy("_gr").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counts = counts.withColumn("_upto", upto).where((F.col("_upto") >= first) & (F.col("_upto") - F.col("_n") < last))
    counts = counts.groupBy("_g").agg(F.min("_gr").alias("_from"), F.max("_gr").alias("_to"), F.min(F.col("_upto") - F.col("_n")).alias("_before"),
                                      F.min("_min").alias("_lo"), F.max("_max").alias("_hi"))
    kept = cut.join(counts, cut[group].eqNullSafe(counts["_g"]) & (F.col("_r") >= F.col("_from")) & (F.col("_r") <= F.col("_to")))
    return kept.drop("_g", "_from", "_to", "_r", "_w", lo, hi, before).withColumnsRenamed({"_lo": lo, "_hi": hi, "_before": before})


def page_per_group(df: DataFrame, group: str, key: str, first: int, last: int, rank_col: str = "rn") -> DataFrame:
    """Rows at the places ``first..last`` (from 1) of each group by the integer
    ``key``, which is unique in it, with the group's number of rows in ``total``.

    A page is found by counting: the keys' ranges are counted per group, then
    the ranges within those that hold the page; only the rows of the last
    ranges are ranked.  A page far down costs what the first one costs.
    """
    bounds = df.groupBy(F.col(group).alias("_grp")).agg(F.min(key).alias("_key_lo"), F.max(key).alias("_key_hi"), F.count(F.lit(1)).alias("total"))
    rows = df.join(bounds, df[group].eqNullSafe(bounds["_grp"])).drop("_grp").withColumn("_rows_before", F.lit(0).cast("long"))
    for _ in range(2):
        rows = _located(rows, group, key, "_key_lo", "_key_hi", first, last, "_rows_before")
    rank = F.row_number().over(Window.partitionBy(group).orderBy(key)) + F.col("_rows_before")
    ranked = rows.withColumn(rank_col, rank.cast("long")).where(F.col(rank_col).between(first, last))
    return ranked.drop("_key_lo", "_key_hi", "_rows_before")


def sale_detail_page(wide: DataFrame, keyword: str, startpage: int, size: int) -> DataFrame:
    """Per day: the rows whose ``sku_name`` matches ``keyword``, page
    ``startpage`` (1-based) of ``size`` rows ordered by detail id, with the
    day's total of matching rows (operator 40)."""
    return page_per_group(matching(wide, keyword), "dt", "order_detail_id", (startpage - 1) * size + 1, startpage * size)


def matching(wide: DataFrame, keyword: str) -> DataFrame:
    return wide.where(token_match(F.col("sku_name"), keyword))


def share_by(wide: DataFrame, keyword: str, attr: str) -> DataFrame:
    """Per day: matching rows counted by ``attr`` and each count's share of
    the day's matching rows (operators 41, 42)."""
    hits = matching(wide, keyword)
    counts = hits.groupBy("dt", attr).agg(F.count(F.lit(1)).alias("n"))
    # per-day total over the (small) aggregated rows, not over the raw rows
    day = Window.partitionBy("dt")
    return counts.withColumn("ratio", F.col("n") / F.sum("n").over(day))


def province_amount(wide: DataFrame) -> DataFrame:
    """Paid amount by day and province for the map (operator 43)."""
    return wide.groupBy("dt", "province_name").agg(money_sum("final_detail_amount", "amount"))


def chart_points(trademark_stat: DataFrame) -> DataFrame:
    """Trademark amounts as chart points ``{x, y, s: "1"}`` (operator 15)."""
    return trademark_stat.select(
        *[c for c in ("dt",) if c in trademark_stat.columns],
        F.col("trademark_name").alias("x"), F.col("amount").alias("y"), F.lit("1").alias("s"),
    )
