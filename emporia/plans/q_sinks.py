"""Sink round trips (operators 55-57, 59, 61): write with the sink, read the
written table back; the oracle is the batch result the sink must preserve."""

from __future__ import annotations

from pyspark.sql import functions as F

from emporia import schemas
from emporia.functions import jsonx
from emporia.operators import ingest
from emporia.plans.catalog import register
from emporia.plans.fixture_sql import with_ctes
from emporia.plans.q_dau import startup_docs
from emporia.plans.warehouse import Warehouse
from emporia.session import scratch_dir
from emporia.sinks.daily import DailyDocs
from emporia.sinks.writers import (
    DimensionVersions,
    append_by_day,
    archive_text_by_day,
    read_day_partitioned,
)
from emporia.sources import messages
from emporia.sources.topics import TopicStore
from emporia.operators import dau as dau_ops


@register("snk_topic", with_ctes(
    "select order_detail_id, order_id, final_detail_amount, 'DWS_ORDER_WIDE' topic from wide", "wide"))
def snk_topic(spark, sf_dir):
    """Wide rows sent to the next topic keyed by order id (operator 55), read
    back and decoded."""
    wide = Warehouse.of(spark, sf_dir).wide
    topics = TopicStore(spark)
    msgs = wide.select(F.col("order_id").cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"),
                       F.lit("DWS_ORDER_WIDE").alias("topic"))
    topics.write_batch(msgs)   # the topic column routes each row
    back = spark.read.text(topics.root).select("value", "topic")
    rec = jsonx.records(back, "value", schemas.ORDER_WIDE, ("order_detail_id", "order_id", "final_detail_amount"), keep=("topic",))
    return rec.select("order_detail_id", "order_id", F.col("final_detail_amount").cast("double").alias("final_detail_amount"), "topic")


@register("snk_dim_upsert", with_ctes(
    "select id, case when id % 10 = 8 then '0' else user_level end user_level, cast(birthday as varchar) birthday, "
    "gender from user_info", "user_info"))
def snk_dim_upsert(spark, sf_dir):
    """User dimension version 1 = version 0 (every level '0') upserted with
    the user change records that pass the CDC filter (operator 56).  Deletes
    do not pass the filter, so those users keep their old row."""
    w = Warehouse.of(spark, sf_dir)
    store = DimensionVersions(spark, scratch_dir(spark, "dim-user"))
    old = w.fx.user_info.select("id", F.lit("0").alias("user_level"), F.col("birthday").cast("string"), "gender")
    store.write_version(old, 0)
    env = messages.cdc_row_envelopes(w.fx).select("value")
    kept = ingest.cdc_rowform_filter(ingest.decode_cdc_row(env)).where(F.col("table") == "user_info")
    rec = kept.select(jsonx.decode(F.col("data"), schemas.USER_INFO).alias("u")).select("u.*")
    changes = rec.withColumn("_ord", F.col("id"))
    v = store.upsert(changes, "_ord", 0)
    return store.read_version(v)


@register("snk_daily_docs", with_ctes("select * from dau", "dau"))
def snk_daily_docs(spark, sf_dir):
    """DAU documents written per day in four batches by device and channel,
    compacted after every second one, two of them replayed, before and after
    their compaction; read back merged on (day, device) (operator 57)."""
    rows = startup_docs(Warehouse.of(spark, sf_dir))
    sink = DailyDocs(spark, scratch_dir(spark, "dau-docs"), compact_every=2)
    part = F.pmod(F.xxhash64("mid", "ch"), F.lit(4))
    for batch_id in (0, 1, 1, 2, 0, 3):
        sink.write(dau_ops.first_visit(rows.where(part == batch_id)), batch_id)
    return sink.read()


@register("snk_wide_append", with_ctes(
    "select order_detail_id, order_id, dt, final_detail_amount, tm_name from wide", "wide"))
def snk_wide_append(spark, sf_dir):
    """Wide rows appended to the day-partitioned wide table (operator 59)."""
    wide = Warehouse.of(spark, sf_dir).wide.select("order_detail_id", "order_id", "dt", "final_detail_amount", "tm_name")
    path = scratch_dir(spark, "order-wide")
    append_by_day(wide, path, 0)
    back = read_day_partitioned(spark, path)
    return back.select("order_detail_id", "order_id", "dt",
                       F.col("final_detail_amount").cast("double").alias("final_detail_amount"), "tm_name")


@register("snk_log_archive", with_ctes("select dt, mid, ts from startup_dated", "startup_dated"))
def snk_log_archive(spark, sf_dir):
    """Raw log lines archived as text, one folder per day, the batch run twice (operator 61)."""
    w = Warehouse.of(spark, sf_dir)
    lines = messages.app_log_lines(w.fx)
    dated = lines.withColumn("dt", F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd"))
    path = scratch_dir(spark, "log-archive")
    for _ in range(2):
        archive_text_by_day(dated, path, 0)
    back = ingest.decode_app_log(read_day_partitioned(spark, path, "text"), keep=("dt",))
    return back.select("dt", F.col("common.mid").alias("mid"), "ts")
