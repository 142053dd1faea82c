"""Ingest queries: JSON decoding, log routing, CDC filtering and fan-out,
document search (operators 2, 5, 7, 9, 13, 14, 16-18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from emporia import schemas
from emporia.functions import jsonx
from emporia.operators import ingest, orders, serve
from emporia.plans.catalog import register
from emporia.plans.fixture_sql import with_ctes
from emporia.plans.warehouse import Warehouse
from emporia.sources import messages

CDC_TYPES_SQL = "[" + ", ".join(f"'{t}'" for t in messages.CDC_TYPE_BY_ID_MOD_10) + "]"

CDC_IDS_SQL = with_ctes(
    "select 'order_info' tbl, id from order_info union all select 'order_detail', id from order_detail "
    "union all select 'base_province', id from province union all select 'user_info', id from user_info "
    "union all select 'sku_info', id from sku",
    "order_info", "order_detail", "province", "user_info", "sku",
)


def _cdc_ids_sql(select: str, where: str = "") -> str:
    body = CDC_IDS_SQL.rsplit("\nselect ", 1)
    ids = "select " + body[1]
    ctes = body[0]
    return (
        f"{ctes},\ncdc_ids as ({ids}),\n"
        f"cdc as (select tbl \"table\", {CDC_TYPES_SQL}[id % 10 + 1] \"type\", id from cdc_ids)\n"
        f"select {select} from cdc {where}"
    )


def _log_lines(w: Warehouse):
    return ingest.decode_app_log(messages.app_log_lines(w.fx))


@register("src_json_decode", with_ctes(
    "select id, province_id, order_status, user_id, cast(final_total_amount as double) final_total_amount, "
    "cast(original_total_amount as double) original_total_amount, create_time, create_date, create_hour, "
    "province_name, user_gender from dwd_order", "dwd_order"))
def src_json_decode(spark, sf_dir):
    """DWD order records as JSON text (a third with quoted numbers) decoded
    back to typed rows: all-string schema, then ``try_cast`` (operator 2)."""
    w = Warehouse.of(spark, sf_dir)
    msgs = messages._json_with_quoted_numbers(w.order_info, "id")
    rec = msgs.select(jsonx.decode(F.col("value"), schemas.ORDER_INFO).alias("r")).select("r.*")
    out = rec.select(
        "id", F.col("province_id").cast("long").alias("province_id"), "order_status", "user_id",
        "final_total_amount", "original_total_amount", "create_time", "create_date", "create_hour",
        "province_name", "user_gender",
    )
    return orders.money_as_double(out, ["final_total_amount", "original_total_amount"])


@register("prj_log_dt_hr", with_ctes("select mid, ts, dt, hr from startup_dated", "startup_dated"))
def prj_log_dt_hr(spark, sf_dir):
    logs = ingest.with_dt_hr(_log_lines(Warehouse.of(spark, sf_dir)))
    return logs.select(F.col("common.mid").alias("mid"), "ts", "dt", "hr")


@register("prj_dau_info", with_ctes(
    "select mid, uid, ar, ch, vc, dt, hr, '00' mi, ts from startup_dated where start_entry is not null",
    "startup_dated"))
def prj_dau_info(spark, sf_dir):
    logs = ingest.route_log(_log_lines(Warehouse.of(spark, sf_dir)))
    starts = logs.where(F.col("topic") == ingest.TOPIC_STARTUP)
    return ingest.dau_info(ingest.with_dt_hr(starts))


@register("flt_log_route", with_ctes(
    "select mid, ch, ts, case when start_entry is not null then 'APP_STARTUP' else 'APP_EVENT' end topic "
    "from startup_log", "startup_log"))
def flt_log_route(spark, sf_dir):
    logs = ingest.route_log(_log_lines(Warehouse.of(spark, sf_dir)))
    return logs.select(F.col("common.mid").alias("mid"), F.col("common.ch").alias("ch"), "ts", "topic")


@register("prj_cdc_topic", _cdc_ids_sql("\"table\", id, 'ODS_T_' || upper(\"table\") topic"))
def prj_cdc_topic(spark, sf_dir):
    ch = messages.cdc_change_rows(Warehouse.of(spark, sf_dir).fx)
    return ch.select("table", "id", ingest.cdc_topic(F.col("table")).alias("topic"))


@register("flt_cdc_rowform", _cdc_ids_sql(
    "'ODS_T_' || upper(\"table\") topic, \"table\", \"type\", id",
    "where (\"table\" = 'order_info' and \"type\" = 'insert') or (\"table\" = 'order_detail' and \"type\" = 'insert') "
    "or (\"table\" = 'base_province' and \"type\" in ('insert', 'update')) "
    "or (\"table\" = 'user_info' and \"type\" in ('insert', 'update')) or \"type\" = 'bootstrap-insert'"))
def flt_cdc_rowform(spark, sf_dir):
    env = messages.cdc_row_envelopes(Warehouse.of(spark, sf_dir).fx).select("value")
    kept = ingest.cdc_rowform_filter(ingest.decode_cdc_row(env))
    return kept.select(
        "topic", "table", "type", F.get_json_object("data", "$.id").cast("long").alias("id")
    )


@register("flt_cdc_arrayform", _cdc_ids_sql("'ODS_T_' || upper(\"table\") topic, \"table\", id"))
def flt_cdc_arrayform(spark, sf_dir):
    env = messages.cdc_array_envelopes(Warehouse.of(spark, sf_dir).fx).select("value")
    rows = ingest.cdc_arrayform_explode(env)
    return rows.select("topic", "table", F.get_json_object("data", "$.id").cast("long").alias("id"))


@register("prj_to_json", with_ctes(
    "select cast(order_id as varchar) \"key\", * exclude (sku_price, benefit_reduce_amount, original_total_amount, feight_fee, "
    "final_total_amount, final_detail_amount), cast(sku_price as double) sku_price, "
    "cast(benefit_reduce_amount as double) benefit_reduce_amount, cast(original_total_amount as double) original_total_amount, "
    "cast(feight_fee as double) feight_fee, cast(final_total_amount as double) final_total_amount, "
    "cast(final_detail_amount as double) final_detail_amount from wide", "wide"))
def prj_to_json(spark, sf_dir):
    """Wide rows as JSON messages keyed by order id for the next topic
    (operator 14), every field read back from the text."""
    wide = Warehouse.of(spark, sf_dir).wide
    msgs = wide.select(F.col("order_id").cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))
    return orders.money_as_double(jsonx.records(msgs, "value", schemas.ORDER_WIDE, keep=("key",)))


@register("src_search_docs", with_ctes(
    "select id, sku_name, tm_id from skus where tm_id between 6 and 10 "
    "and list_contains(regexp_split_to_array(lower(sku_name), '[^\\p{L}\\p{N}_]+'), 'red')", "skus"))
def src_search_docs(spark, sf_dir):
    """Document search: numeric range filter (6..10) AND a term match on the
    analysed name (lower-cased, split on non-word characters) (operator 5)."""
    skus = Warehouse.of(spark, sf_dir).skus
    hits = serve.search_docs(skus, "sku_name", "red", "tm_id", 6, 10)
    return hits.select("id", "sku_name", "tm_id")
