"""Mart queries over wide rows (operators 28-32)."""

from __future__ import annotations

from emporia.operators import marts
from emporia.plans.catalog import register
from emporia.plans.fixture_sql import with_ctes
from emporia.plans.warehouse import Warehouse

# A fixed batch time stands in for the reference's wall clock in batch runs.
BATCH_STAT_TIME = "2024-01-31 00:00:00"


@register("agg_trademark_day", with_ctes(
    "select dt, tm_name trademark_name, cast(sum(cast(final_detail_amount as decimal(18,2))) as double) amount "
    "from wide group by dt, tm_name", "wide"))
def agg_trademark_day(spark, sf_dir):
    return marts.trademark_day(Warehouse.of(spark, sf_dir).paid_trademarks)


@register("agg_trademark_batch", with_ctes(
    f"select '{BATCH_STAT_TIME}' stat_time, tm_name trademark_name, "
    "cast(sum(cast(final_detail_amount as decimal(18,2))) as double) amount from wide group by tm_name", "wide"))
def agg_trademark_batch(spark, sf_dir):
    return marts.trademark_batch(Warehouse.of(spark, sf_dir).paid_trademarks, BATCH_STAT_TIME)


@register("agg_order_amount_total", with_ctes(
    "select dt, cast(sum(cast(final_total_amount as decimal(18,2))) as double) order_amount from wide_unsplit group by dt",
    "wide_unsplit"))
def agg_order_amount_total(spark, sf_dir):
    return marts.order_amount_total(Warehouse.of(spark, sf_dir).order_lines)


@register("agg_order_amount_hour", with_ctes(
    "select dt, cast(hour(strptime(create_time, '%Y-%m-%d %H:%M:%S')) as bigint) hr, "
    "cast(sum(cast(final_total_amount as decimal(18,2))) as double) order_amount from wide_unsplit group by all",
    "wide_unsplit"))
def agg_order_amount_hour(spark, sf_dir):
    return marts.order_amount_hour(Warehouse.of(spark, sf_dir).order_lines)


@register("agg_order_share_hour", with_ctes(
    "select dt, cast(hour(strptime(create_time, '%Y-%m-%d %H:%M:%S')) as bigint) hr, "
    "cast(sum(cast(final_detail_amount as decimal(18,2))) as double) order_amount from wide group by all "
    "union all select dt, null, cast(sum(cast(final_detail_amount as decimal(18,2))) as double) from wide group by dt",
    "wide"))
def agg_order_share_hour(spark, sf_dir):
    return marts.order_share_hour(Warehouse.of(spark, sf_dir).paid_lines)
