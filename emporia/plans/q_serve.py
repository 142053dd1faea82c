"""Serving queries: paged detail search, buyer shares, province sales,
chart points (operators 15, 40-43)."""

from __future__ import annotations

from pyspark.sql import functions as F

from emporia.operators import marts, orders, serve, split
from emporia.plans.catalog import register
from emporia.plans.fixture_sql import with_ctes
from emporia.plans.warehouse import Warehouse
from emporia.session import stored

# Parameters of the registered dashboard queries (as a user would call them).
KEYWORD = "red"
STARTPAGE = 2
PAGE_SIZE = 5

MATCH_SQL = f"list_contains(regexp_split_to_array(lower(sku_name), '[^\\p{{L}}\\p{{N}}_]+'), '{KEYWORD}')"


@register("srv_sale_detail_page", with_ctes(
    "select order_detail_id, order_id, dt, sku_name, sku_num, final_detail_amount, user_gender, user_age_group, "
    "province_name, rn, total from ("
    f"select *, row_number() over (partition by dt order by order_detail_id) rn, count(*) over (partition by dt) total "
    f"from wide where {MATCH_SQL}) x "
    f"where rn > {(STARTPAGE - 1) * PAGE_SIZE} and rn <= {STARTPAGE * PAGE_SIZE}", "wide"))
def srv_sale_detail_page(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    # the page's place among the ids of all matching rows, then the rows of the page
    hits = stored(serve.matching(w.order_lines, KEYWORD).select("dt", "order_detail_id", "order_id"), "sale-hits")
    place = stored(serve.page_per_group(hits, "dt", "order_detail_id", (STARTPAGE - 1) * PAGE_SIZE + 1, STARTPAGE * PAGE_SIZE), "sale-page")
    # only the orders of the page are split and enriched
    orders_of = place.select(F.col("order_id").alias("_page_order")).distinct()
    lines = w.order_lines.join(orders_of, w.order_lines["order_id"] == orders_of["_page_order"], "left_semi")
    paid = split.amount_split(lines)
    on_page = place.select(F.col("order_detail_id").alias("_page_id"), "rn", "total")
    page = w.widened(paid.join(on_page, paid["order_detail_id"] == on_page["_page_id"], "left_semi"))
    page = page.join(on_page, page["order_detail_id"] == on_page["_page_id"]).select("order_detail_id", "order_id", "dt", "sku_name", "sku_num", "final_detail_amount",
                       "user_gender", "user_age_group", "province_name", "rn", "total")
    return orders.money_as_double(page, ["final_detail_amount"]).withColumn("rn", page["rn"].cast("long"))


@register("srv_gender_share", with_ctes(
    "select dt, user_gender, count(*) n, count(*) / sum(count(*)) over (partition by dt) ratio "
    f"from wide where {MATCH_SQL} group by dt, user_gender", "wide"))
def srv_gender_share(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return serve.share_by(orders.join_user(w.order_lines, w.users), KEYWORD, "user_gender")


@register("srv_age_share", with_ctes(
    "select dt, user_age_group, count(*) n, count(*) / sum(count(*)) over (partition by dt) ratio "
    f"from wide where {MATCH_SQL} group by dt, user_age_group", "wide"))
def srv_age_share(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return serve.share_by(orders.join_user(w.order_lines, w.users), KEYWORD, "user_age_group")


@register("srv_province_amount", with_ctes(
    "select dt, province_name, cast(sum(cast(final_detail_amount as decimal(18,2))) as double) amount "
    "from wide group by dt, province_name", "wide"))
def srv_province_amount(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return serve.province_amount(orders.join_province(w.paid_lines, w.fx.province))


@register("prj_chart_points", with_ctes(
    "select dt, tm_name x, cast(sum(cast(final_detail_amount as decimal(18,2))) as double) y, '1' s "
    "from wide group by dt, tm_name", "wide"))
def prj_chart_points(spark, sf_dir):
    return serve.chart_points(marts.trademark_day(Warehouse.of(spark, sf_dir).paid_trademarks))
