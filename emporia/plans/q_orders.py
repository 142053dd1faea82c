"""Order-side queries: enrichment joins, wide rows, amount split, first order."""

from __future__ import annotations

from pyspark.sql import functions as F

from emporia.operators import dims, orders
from emporia.plans.catalog import register
from emporia.plans.fixture_sql import with_ctes
from emporia.plans.warehouse import Warehouse

def _bigint(df, *cols):
    return df.select(*[F.col(c).cast("long").alias(c) if c in cols else F.col(c) for c in df.columns])


@register("prj_order_date_hour", with_ctes(
    "select id, strftime(create_time, '%Y-%m-%d %H:%M:%S') create_time, strftime(create_time, '%Y-%m-%d') create_date, "
    "strftime(create_time, '%H') create_hour from order_info", "order_info"))
def prj_order_date_hour(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return orders.with_date_hour(w.fx.order_info).select("id", "create_time", "create_date", "create_hour")


@register("prj_user_age_group", with_ctes(
    "select id, cast(birthday as varchar) birthday, age_group from users", "users"))
def prj_user_age_group(spark, sf_dir):
    return Warehouse.of(spark, sf_dir).users.select("id", F.col("birthday").cast("string").alias("birthday"), "age_group")


@register("prj_user_gender_name", with_ctes("select id, gender, gender_name from users", "users"))
def prj_user_gender_name(spark, sf_dir):
    return Warehouse.of(spark, sf_dir).users.select("id", "gender", "gender_name")


@register("join_order_province", with_ctes(
    "select id, province_id, province_name, province_area_code, province_3166_2_code from dwd_order", "dwd_order"))
def join_order_province(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    o = orders.join_province(w.fx.order_info, w.fx.province)
    return o.select("id", "province_id", "province_name", "province_area_code", "province_3166_2_code")


@register("join_order_user", with_ctes(
    "select id, user_id, user_gender, user_age_group from dwd_order", "dwd_order"))
def join_order_user(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    o = orders.join_user(w.fx.order_info, w.users)
    return o.select("id", "user_id", "user_gender", "user_age_group")


@register("join_sku_dims", with_ctes(
    "select id, cast(spu_id as bigint) spu_id, price, sku_name, tm_id, cast(category3_id as bigint) category3_id, "
    "category3_name, spu_name, tm_name from skus", "skus"))
def join_sku_dims(spark, sf_dir):
    s = Warehouse.of(spark, sf_dir).skus
    return _bigint(s, "spu_id", "category3_id")


@register("join_detail_sku", with_ctes(
    "select id, order_id, sku_id, cast(order_price as double) order_price, cast(sku_num as bigint) sku_num, sku_name, "
    "create_time, cast(spu_id as bigint) spu_id, tm_id, cast(category3_id as bigint) category3_id, spu_name, tm_name, "
    "category3_name from dwd_detail", "dwd_detail"))
def join_detail_sku(spark, sf_dir):
    d = Warehouse.of(spark, sf_dir).order_detail
    d = d.withColumn("order_price", F.col("order_price").cast("double"))
    return _bigint(d, "sku_num", "spu_id", "category3_id")


@register("src_dim_lookup", with_ctes(
    "select * replace (cast(birthday as varchar) as birthday) from users "
    "where id in (select user_id from order_info where order_status = 'F')",
    "users", "order_info"))
def src_dim_lookup(spark, sf_dir):
    """User dimension rows for the users of finished orders: a semi join, the
    set form of the reference's per-partition ``IN (...)`` lookup."""
    w = Warehouse.of(spark, sf_dir)
    wanted = w.fx.order_info.where(F.col("order_status") == "F").select(F.col("user_id").alias("id"))
    return dims.lookup_by_ids(w.users, wanted).withColumn("birthday", F.col("birthday").cast("string"))


@register("prj_order_wide", with_ctes(
    "select * exclude (sku_price, benefit_reduce_amount, original_total_amount, feight_fee, final_total_amount), "
    "cast(sku_price as double) sku_price, cast(benefit_reduce_amount as double) benefit_reduce_amount, "
    "cast(original_total_amount as double) original_total_amount, cast(feight_fee as double) feight_fee, "
    "cast(final_total_amount as double) final_total_amount from wide_unsplit", "wide_unsplit"))
def prj_order_wide(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir).wide_unsplit.drop("final_detail_amount")
    return orders.money_as_double(w)


@register("win_amount_split", with_ctes(
    "select order_detail_id, order_id, dt, cast(sku_price as double) sku_price, "
    "cast(original_total_amount as double) original_total_amount, "
    "cast(final_total_amount as double) final_total_amount, final_detail_amount from wide", "wide"))
def win_amount_split(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir).wide.select(
        "order_detail_id", "order_id", "dt", "sku_price", "original_total_amount", "final_total_amount",
        "final_detail_amount",
    )
    return orders.money_as_double(w)


@register("win_first_order_flag", with_ctes(
    "select id, user_id, strftime(create_time, '%Y-%m-%d %H:%M:%S') create_time, "
    "case when row_number() over (partition by user_id order by create_time, id) = 1 then '1' else '0' end if_first_order "
    "from order_info", "order_info"))
def win_first_order_flag(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    f = orders.first_order_flag(w.fx.order_info)
    return f.withColumn("create_time", F.date_format("create_time", "yyyy-MM-dd HH:mm:ss"))


@register("join_order_detail_fullouter", with_ctes(
    "select d.id order_detail_id, coalesce(o.id, d.order_id) order_id, o.create_time, d.sku_id "
    "from dwd_detail d full outer join dwd_order o on o.id = d.order_id", "dwd_detail", "dwd_order"))
def join_order_detail_fullouter(spark, sf_dir):
    """Full outer order-line join: orders without lines (and lines without an
    order) are kept with nulls on the other side (operator 27)."""
    w = Warehouse.of(spark, sf_dir)
    j = orders.join_order_detail(w.order_info, w.order_detail, "full_outer")
    return j.select("order_detail_id", "order_id", "create_time", "sku_id")
