"""Order-side operators: DWD order and order-line enrichment, the wide row.

All are plain DataFrame -> DataFrame functions; the stream jobs call the same
functions inside ``foreachBatch`` or directly on streaming frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions.timefmt import as_text, date_part_of, hour_part_of

ORDER_INFO_COLUMNS = [
    "id", "province_id", "order_status", "user_id", "final_total_amount", "benefit_reduce_amount",
    "original_total_amount", "feight_fee", "expire_time", "create_time", "operate_time", "create_date",
    "create_hour", "if_first_order", "province_name", "province_area_code", "province_3166_2_code",
    "user_age_group", "user_gender",
]

ORDER_DETAIL_COLUMNS = [
    "id", "order_id", "sku_id", "order_price", "sku_num", "sku_name", "create_time", "spu_id", "tm_id",
    "category3_id", "spu_name", "tm_name", "category3_name",
]

ORDER_WIDE_COLUMNS = [
    "order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id", "sku_price", "sku_num",
    "sku_name", "benefit_reduce_amount", "original_total_amount", "feight_fee", "final_total_amount",
    "final_detail_amount", "if_first_order", "province_name", "province_area_code", "user_age_group",
    "user_gender", "dt", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name",
]

MONEY_COLUMNS = [
    "sku_price", "benefit_reduce_amount", "original_total_amount", "feight_fee", "final_total_amount",
    "final_detail_amount",
]


def with_date_hour(order_info: DataFrame) -> DataFrame:
    """``create_time`` as text plus ``create_date`` and ``create_hour`` split
    from it (operator 8)."""
    ct = F.col("create_time")
    text = as_text(ct) if dict(order_info.dtypes)["create_time"] != "string" else ct
    return (
        order_info.withColumn("create_time", text)
        .withColumn("create_date", date_part_of(F.col("create_time")))
        .withColumn("create_hour", hour_part_of(F.col("create_time")))
    )


def join_province(order_info: DataFrame, province: DataFrame) -> DataFrame:
    """Left join with the province dimension (operator 21): name, area code,
    ISO 3166-2 code; nulls when the province is unknown.  No hint: the
    planner broadcasts the province list from its measured size (file
    statistics, then AQE's runtime statistics), never on trust."""
    p = province.select(
        F.col("id").alias("_pid"),
        F.col("name").alias("province_name"),
        F.col("area_code").alias("province_area_code"),
        F.col("iso_3166_2").alias("province_3166_2_code"),
    )
    return order_info.join(p, order_info["province_id"] == p["_pid"], "left").drop("_pid")


def join_user(order_info: DataFrame, users: DataFrame) -> DataFrame:
    """Left join with the user dimension (operator 22): gender label and age
    group.  Users grow with the business, so no hint: AQE broadcasts when the
    user side is small at runtime and splits a hot user's partition otherwise."""
    u = users.select(
        F.col("id").alias("_uid"),
        F.col("gender_name").alias("user_gender"),
        F.col("age_group").alias("user_age_group"),
    )
    return order_info.join(u, order_info["user_id"] == u["_uid"], "left").drop("_uid")


def dwd_order_info(order_info: DataFrame, province: DataFrame, users: DataFrame) -> DataFrame:
    """The DWD order: date/hour split, province and user attributes, the
    19 columns of the reference's order bean."""
    o = with_date_hour(order_info)
    o = join_user(join_province(o, province), users)
    return o.select(
        "id", "province_id", "order_status", "user_id", "final_total_amount", "benefit_reduce_amount",
        "original_total_amount", "feight_fee",
        F.lit(None).cast("string").alias("expire_time"),
        "create_time",
        F.lit(None).cast("string").alias("operate_time"),
        "create_date", "create_hour",
        F.lit(None).cast("string").alias("if_first_order"),
        "province_name", "province_area_code", "province_3166_2_code", "user_age_group", "user_gender",
    )


def dwd_order_detail(order_detail: DataFrame, skus: DataFrame) -> DataFrame:
    """Order line + sku dimension (operator 24).  Left join: an unknown sku
    gives nulls instead of the reference's null-pointer failure (D8), and the
    joined rows are the ones emitted (D2)."""
    s = skus.select(
        F.col("id").alias("_sku"), "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name"
    )
    d = order_detail
    if dict(d.dtypes)["create_time"] != "string":
        d = d.withColumn("create_time", as_text(F.col("create_time")))
    return d.join(s, d["sku_id"] == s["_sku"], "left").select(*ORDER_DETAIL_COLUMNS)


def join_order_detail(order: DataFrame, detail: DataFrame, how: str = "inner") -> DataFrame:
    """Order ⋈ line on the order id, projected to the wide row (operators 12,
    25 in batch form, 27 with ``how='full_outer'``).

    Both sides shuffle on the order id; the amount split that follows reuses
    that partitioning.  The wide row takes the order's ``create_time`` and
    ``create_date`` (as ``dt``), like the reference's merge.
    """
    o = order.select(
        F.col("id").alias("_oid"), "order_status", F.col("create_time").alias("_o_create_time"), "user_id",
        "benefit_reduce_amount", "original_total_amount", "feight_fee", "final_total_amount", "if_first_order",
        "province_name", "province_area_code", "user_age_group", "user_gender",
        F.col("create_date").alias("dt"),
    )
    d = detail.select(
        F.col("id").alias("order_detail_id"), F.col("order_id").alias("_d_order_id"), "sku_id",
        F.col("order_price").alias("sku_price"), F.col("sku_num").cast("long").alias("sku_num"), "sku_name",
        F.col("spu_id").cast("long").alias("spu_id"), F.col("tm_id").cast("long").alias("tm_id"),
        F.col("category3_id").cast("long").alias("category3_id"), "spu_name", "tm_name", "category3_name",
    )
    j = d.join(o, d["_d_order_id"] == o["_oid"], how)
    # inner: keep the line side's key, so the hash partitioning of the join
    # is recognised downstream (the split reuses it without a new exchange)
    oid = F.col("_d_order_id") if how == "inner" else F.coalesce(F.col("_oid"), F.col("_d_order_id"))
    return j.select(
        "order_detail_id",
        oid.alias("order_id"),
        "order_status",
        F.col("_o_create_time").alias("create_time"),
        "user_id", "sku_id", "sku_price", "sku_num", "sku_name", "benefit_reduce_amount", "original_total_amount",
        "feight_fee", "final_total_amount",
        F.lit(None).cast("decimal(12,2)").alias("final_detail_amount"),
        "if_first_order", "province_name", "province_area_code", "user_age_group", "user_gender", "dt",
        "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name",
    )


def order_lines(order_info: DataFrame, order_detail: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Order ⋈ line on the order id before any enrichment: the columns of the
    wide row that orders and lines have themselves, ``province_id``, and the
    columns ``carry`` of either side."""
    o = with_date_hour(order_info).select(
        F.col("id").alias("_oid"), "order_status", F.col("create_time").alias("_o_create_time"), "user_id", "province_id",
        "benefit_reduce_amount", "original_total_amount", "feight_fee", "final_total_amount", F.col("create_date").alias("dt"),
        *[c for c in carry if c in order_info.columns],
    )
    d = order_detail.select(
        F.col("id").alias("order_detail_id"), "order_id", "sku_id", F.col("order_price").alias("sku_price"),
        F.col("sku_num").cast("long").alias("sku_num"), "sku_name",
        *[c for c in carry if c in order_detail.columns],
    )
    j = d.join(o, d["order_id"] == o["_oid"])
    return j.select(
        "order_detail_id", "order_id", "order_status", F.col("_o_create_time").alias("create_time"), "user_id", "province_id", "sku_id",
        "sku_price", "sku_num", "sku_name", "benefit_reduce_amount", "original_total_amount", "feight_fee", "final_total_amount",
        F.lit(None).cast("decimal(12,2)").alias("final_detail_amount"), "dt", *carry,
    )


USER_ATTRIBUTES, SKU_ATTRIBUTES = "_user_rows", "_sku_rows"


def with_user_rows(order_info: DataFrame, users: DataFrame) -> DataFrame:
    """Orders with the rows of their user in an array (null without any): a
    left join that multiplies no order, so that it can come before the split
    and shuffle orders instead of their lines."""
    row = F.struct(F.col("gender_name").alias("user_gender"), F.col("age_group").alias("user_age_group"))
    u = users.groupBy(F.col("id").alias("_uid")).agg(F.collect_list(row).alias(USER_ATTRIBUTES))
    return order_info.join(u, order_info["user_id"] == u["_uid"], "left").drop("_uid")


def with_sku_rows(order_detail: DataFrame, skus: DataFrame) -> DataFrame:
    """Lines with the rows of their sku in an array (null without any)."""
    row = F.struct(*[F.col(c).cast("long").alias(c) for c in ("spu_id", "tm_id", "category3_id")], "spu_name", "tm_name", "category3_name")
    s = skus.groupBy(F.col("id").alias("_sku")).agg(F.collect_list(row).alias(SKU_ATTRIBUTES))
    return order_detail.join(s, order_detail["sku_id"] == s["_sku"], "left").drop("_sku")


def unfolded(lines: DataFrame, province: DataFrame) -> DataFrame:
    """``order_lines`` that carry user and sku rows -> the wide row, as
    ``widened`` gives it: a row of each for every line, nulls where there is none."""
    rows = lines.withColumn("_u", F.explode_outer(USER_ATTRIBUTES)).withColumn("_s", F.explode_outer(SKU_ATTRIBUTES))
    rows = rows.select(*lines.columns, "_u.*", "_s.*").withColumn("if_first_order", F.lit(None).cast("string"))
    return join_province(rows, province).select(*ORDER_WIDE_COLUMNS)


def widened(lines: DataFrame, province: DataFrame, users: DataFrame, skus: DataFrame) -> DataFrame:
    """``order_lines`` (split or not) -> the wide row: each dimension is joined
    once, after the split.  The provinces come last: the joins before shuffle
    the rows where users and skus are many, and need not carry their names."""
    s = skus.select(F.col("id").alias("_sku"), *[F.col(c).cast("long").alias(c) for c in ("spu_id", "tm_id", "category3_id")],
                    "spu_name", "tm_name", "category3_name")
    rows = join_user(lines, users)
    rows = rows.join(s, rows["sku_id"] == s["_sku"], "left").withColumn("if_first_order", F.lit(None).cast("string"))
    return join_province(rows, province).select(*ORDER_WIDE_COLUMNS)


def first_order_flag(order_info: DataFrame) -> DataFrame:
    """``if_first_order`` per order (operator 45): ``"1"`` for a user's
    earliest order (by create time, then id), else ``"0"``.

    Skew-safe form of ``row_number() over (partition by user_id ...) = 1``:
    the earliest order per user is a ``min_by`` aggregate (pre-aggregated on
    the map side, so a user with a third of all orders costs nothing extra),
    and it is joined back on the *order id*, which is unique.
    """
    firsts = order_info.groupBy("user_id").agg(
        F.min_by(F.col("id"), F.struct(F.col("create_time"), F.col("id"))).alias("_first_id")
    ).select("_first_id")
    j = order_info.join(firsts, order_info["id"] == firsts["_first_id"], "left")
    return j.select(
        "id", "user_id", "create_time",
        F.when(F.col("_first_id").isNotNull(), F.lit("1")).otherwise(F.lit("0")).alias("if_first_order"),
    )


def money_as_double(df: DataFrame, cols=None) -> DataFrame:
    """Decimal money columns to double, once, at the very end."""
    cols = cols or [c for c in MONEY_COLUMNS if c in df.columns]
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])
