"""Daily-active-device and KPI queries (operators 33-39)."""

from __future__ import annotations

from pyspark.sql import functions as F

from emporia.operators import dau, ingest, kpi, marts
from emporia.plans.catalog import register
from emporia.plans.fixture_sql import with_ctes
from emporia.plans.warehouse import Warehouse
from emporia.sources import messages


def startup_docs(w: Warehouse):
    """Startup logs as DAU-shaped rows."""
    lines = messages.app_log_lines(w.fx)
    logs = ingest.route_log(ingest.decode_app_log(lines))
    starts = logs.where(F.col("topic") == ingest.TOPIC_STARTUP)
    return ingest.with_dt_hr(starts).select(
        F.col("common.mid").alias("mid"), F.col("common.uid").alias("uid"), F.col("common.ar").alias("ar"),
        F.col("common.ch").alias("ch"), F.col("common.vc").alias("vc"), "dt", "hr", F.lit("00").alias("mi"), "ts",
    )


def dau_docs(w: Warehouse):
    return dau.first_visit(startup_docs(w))


DAU_T = "dau_t as (select dt, count(*) dau from dau group by dt)"
NEW_MID = "nm as (select dt, count(*) new_mid from (select mid, min(dt) dt from dau group by mid) f group by dt)"
ORDER_T = ("ot as (select dt, cast(sum(cast(final_total_amount as decimal(18,2))) as double) order_amount "
           "from wide_unsplit group by dt)")
DAU_H = "dh as (select dt, hr, count(*) n from dau group by dt, hr)"
ORDER_H = ("oh as (select dt, lpad(cast(hour(strptime(create_time, '%Y-%m-%d %H:%M:%S')) as varchar), 2, '0') hr, "
           "cast(sum(cast(final_total_amount as decimal(18,2))) as double) v from wide_unsplit group by all)")
HOURLY = ("hourly as (select 'dau' id, dt, hr, cast(n as double) \"value\" from dh "
          "union all select 'order_amount', dt, hr, v from oh)")


def _chain(sql_tail: str, *parts: str) -> str:
    base = with_ctes("select 1", "dau", "wide_unsplit")
    head = base.rsplit("\nselect 1", 1)[0]
    return head + ",\n" + ",\n".join(parts) + "\n" + sql_tail


@register("agg_dau_total", with_ctes("select dt, count(*) dau from dau group by dt", "dau"))
def agg_dau_total(spark, sf_dir):
    return dau.dau_total(dau_docs(Warehouse.of(spark, sf_dir)))


@register("agg_dau_hour", with_ctes(
    "select dt, hr, n from (select dt, hr, count(*) n, row_number() over (partition by dt order by count(*) desc, hr) r "
    "from dau group by dt, hr) x where r <= 24", "dau"))
def agg_dau_hour(spark, sf_dir):
    return dau.dau_hour(dau_docs(Warehouse.of(spark, sf_dir)))


@register("kpi_new_device", with_ctes(
    "select dt, count(*) new_mid from (select mid, min(dt) dt from dau group by mid) f group by dt", "dau"))
def kpi_new_device(spark, sf_dir):
    return dau.new_devices(dau_docs(Warehouse.of(spark, sf_dir)))


def _hourly(w: Warehouse):
    d = dau.dau_hour(dau_docs(w))
    o = marts.order_amount_hour(w.wide_unsplit)
    return kpi.hourly_long(d, o)


@register("kpi_realtime_total", _chain(
    "select g.dt, g.id, g.name, coalesce(l.\"value\", 0) \"value\" from grid g left join long l on l.dt = g.dt and l.id = g.id",
    DAU_T, NEW_MID, ORDER_T,
    "long as (select dt, 'dau' id, cast(dau as double) \"value\" from dau_t union all "
    "select dt, 'new_mid', cast(new_mid as double) from nm union all select dt, 'order_amount', order_amount from ot)",
    "grid as (select d.dt, k.id, k.name from (select distinct dt from long) d, "
    "(values ('dau', '新增日活'), ('new_mid', '新增设备'), ('order_amount', '新增交易额')) k(id, name))"))
def kpi_realtime_total(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    docs = dau_docs(w)
    return kpi.realtime_total(dau.dau_total(docs), dau.new_devices(docs), marts.order_amount_total(w.wide_unsplit))


@register("kpi_today_vs_yesterday", _chain(
    "select coalesce(t.id, y.id) id, coalesce(t.dt, y.dt) dt, coalesce(t.hr, y.hr) hr, t.\"value\" today, "
    "y.\"value\" yesterday from hourly t full outer join "
    "(select id, strftime(cast(dt as date) + 1, '%Y-%m-%d') dt, hr, \"value\" from hourly) y "
    "on t.id = y.id and t.dt = y.dt and t.hr = y.hr "
    "where coalesce(t.dt, y.dt) in (select dt from hourly)",
    DAU_H, ORDER_H, HOURLY))
def kpi_today_vs_yesterday(spark, sf_dir):
    return kpi.today_vs_yesterday(_hourly(Warehouse.of(spark, sf_dir)))


@register("kpi_hour_zero_fill", _chain(
    "select k.id, k.dt, k.hr, coalesce(h.\"value\", 0) \"value\" from "
    "(select distinct id, dt, lpad(cast(x.h as varchar), 2, '0') hr from hourly, range(24) x(h)) k "
    "left join hourly h on h.id = k.id and h.dt = k.dt and h.hr = k.hr",
    DAU_H, ORDER_H, HOURLY))
def kpi_hour_zero_fill(spark, sf_dir):
    return kpi.hour_zero_fill(_hourly(Warehouse.of(spark, sf_dir)))


@register("kpi_hour_map", _chain(
    "select id, dt, count(*) n_hours, string_agg(hr || '=' || cast(cast(\"value\" as decimal(18, 2)) as varchar), ';' order by hr) as hours "
    "from hourly group by id, dt",
    DAU_H, ORDER_H, HOURLY))
def kpi_hour_map(spark, sf_dir):
    """hour -> value maps per KPI and day, their entries written out in order (operator 38)."""
    maps = kpi.hour_map(_hourly(Warehouse.of(spark, sf_dir)))
    entries = F.transform(F.map_entries("hours"), lambda e: F.concat(e.key, F.lit("="), e.value.cast("decimal(18, 2)").cast("string")))
    return maps.select("id", "dt", F.size("hours").cast("long").alias("n_hours"), F.array_join(entries, ";").alias("hours"))
