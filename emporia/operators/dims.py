"""Dimension-table operators: user labels, the sku dimension, lookups, upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.functions.labels import DEFAULT_AS_OF, age_group, gender_name


def user_dim(user_info: DataFrame, as_of: str | Column = DEFAULT_AS_OF) -> DataFrame:
    """UserInfo with ``age_group`` and ``gender_name`` (operators 10, 11)."""
    as_of_col = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return user_info.select(
        "id",
        "user_level",
        "birthday",
        "gender",
        age_group(F.col("birthday"), as_of_col).alias("age_group"),
        gender_name(F.col("gender")).alias("gender_name"),
    )


def sku_dim(sku: DataFrame, category3: DataFrame, trademark: DataFrame, spu: DataFrame) -> DataFrame:
    """SkuInfo with category, trademark and spu names: three left lookups
    (operator 23).  The catalogues are small; Spark broadcasts each one when
    its measured size (scan statistics, or AQE's runtime shuffle statistics
    for derived catalogues) is under the broadcast threshold, and falls back
    to a shuffled join otherwise - no blind hint."""
    k3 = category3.select(F.col("id").alias("k3_id"), F.col("name").alias("category3_name"))
    tm = trademark.select(F.col("tm_id").alias("t_id"), "tm_name")
    sp = spu.select(F.col("id").alias("s_id"), "spu_name")
    return (
        sku.join(k3, sku["category3_id"] == k3["k3_id"], "left")
        .join(tm, sku["tm_id"] == tm["t_id"], "left")
        .join(sp, sku["spu_id"] == sp["s_id"], "left")
        .select(
            sku["id"], sku["spu_id"], sku["price"], sku["sku_name"], sku["tm_id"], sku["category3_id"],
            "category3_name", "spu_name", "tm_name",
        )
    )


def join_trademark(lines: DataFrame, sku: DataFrame, trademark: DataFrame) -> DataFrame:
    """Order lines with ``tm_name``: the one sku attribute that sales by
    trademark need, without the sku's other lookups."""
    s = sku.select(F.col("id").alias("_sku"), F.col("tm_id").alias("_tm"))
    t = trademark.select(F.col("tm_id").alias("_t_id"), "tm_name")
    named = s.join(t, s["_tm"] == t["_t_id"], "left").select("_sku", "tm_name")
    return lines.join(named, lines["sku_id"] == named["_sku"], "left").drop("_sku")


def lookup_by_ids(dim: DataFrame, wanted: DataFrame, dim_key: str = "id", wanted_key: str = "id") -> DataFrame:
    """Rows of ``dim`` whose key occurs in ``wanted`` (operator 3).

    The reference builds an ``IN ('..','..')`` string per partition; here it is
    a left-semi join, which Spark turns into a broadcast or shuffled semi join
    and, for partitioned dimension tables, a runtime filter on the scan.
    """
    ids = wanted.select(F.col(wanted_key).alias("_wanted_id"))
    return dim.join(ids, dim[dim_key] == ids["_wanted_id"], "left_semi")


def upsert_latest(current: DataFrame, changes: DataFrame, key: str, order_col: str) -> DataFrame:
    """New version of a dimension table after applying change rows (operator 56).

    ``current`` rows rank below every change row; among change rows the one
    with the greatest ``order_col`` wins.  ``max_by`` is an aggregate, so a
    hot key is pre-aggregated on the map side before the shuffle.
    """
    cols = [c for c in current.columns]
    cur = current.select(*cols, F.lit(-1).cast("long").alias("_ord"))
    chg = changes.select(*cols, F.col(order_col).cast("long").alias("_ord"))
    both = cur.unionByName(chg)
    latest = both.groupBy(key).agg(
        F.max_by(F.struct(*[c for c in cols if c != key]), F.col("_ord")).alias("_row")
    )
    return latest.select(key, "_row.*").select(*cols)
