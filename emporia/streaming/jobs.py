"""Structured Streaming versions of the reference's DStream jobs
(operators 25, 26, 47-52, 54).

Every function takes streaming frames and returns a streaming frame (or a
``foreachBatch`` writer), reusing the batch operators wherever the step is
stateless.  State lives in the state store (RocksDB by session default) and
is bounded by watermarks; outputs are exactly-once (file sinks with their
commit log, or ``foreachBatch`` writes keyed by ``batch_id``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia import schemas
from emporia.functions import jsonx
from emporia.operators import dau, dims, ingest, orders
from emporia.session import SHUFFLE_CLEANUP, scratch_dir, set_for
from emporia.sinks.dimensions import DimTable
from emporia.sources.topics import COMPRESSION
from emporia.streaming import split_state
from emporia.streaming.commits import BatchCommits, Output

# Allowed lateness of events behind the newest one seen (watermark delay).
DEFAULT_LATENESS = "1 hour"
# The reference joins an order and its lines when they arrive within one
# 10 s window; the cached variant keeps unmatched rows for 600 s.
WINDOW_JOIN_BOUND_S = 10
CACHED_JOIN_BOUND_S = 600
# Parts that an order's lines are dealt over in the join's state.
JOIN_SALTS = 4
# State partitions a core, at most: a batch opens, commits and uploads the state
# of each, however few of its rows fall there, and a trigger's size is bounded.
STATE_PARTITIONS_PER_CORE = 2


# ---- DAU ------------------------------------------------------------------

def dau_first_visit_stream(log_lines: DataFrame, lateness: str = DEFAULT_LATENESS) -> DataFrame:
    """First startup record per (day, device) as a streaming aggregate
    (operator 47), for ``outputMode("update")`` into a keyed sink.

    The least record (``dau.FIRST_ORDER``) by (day window, mid) is partially aggregated on the map side,
    so a device sending a third of a batch's records is reduced per task
    before the shuffle; state is one row per (day, device), dropped when the
    watermark closes the day.  The result is the first record of the day by
    the batch operator's own order, independent of arrival order; a key
    re-emitted by a later batch carries the same or an earlier record, and
    the sink keeps the earliest (``sinks.daily``)."""
    logs = ingest.route_log(ingest.decode_app_log(log_lines))
    starts = logs.where(F.col("topic") == ingest.TOPIC_STARTUP)
    docs = ingest.dau_info(ingest.with_dt_hr(starts))
    timed = docs.withColumn("_et", F.timestamp_millis("ts")).withWatermark("_et", lateness)
    g = timed.groupBy(F.window("_et", "1 day").alias("_day"), "dt", "mid").agg(dau.first_of_group().alias("_doc"))
    return g.select("dt", "mid", *[F.col(f"_doc.{c}").alias(c) for c in dau.FIRST_ORDER])


# ---- order / line join ------------------------------------------------------

def decode_orders(values: DataFrame) -> DataFrame:
    return jsonx.records(values, "value", schemas.ORDER_INFO)


def decode_details(values: DataFrame) -> DataFrame:
    return jsonx.records(values, "value", schemas.ORDER_DETAIL)


def order_detail_join(order_values: DataFrame, detail_values: DataFrame, bound_s: int,
                      lateness: str = DEFAULT_LATENESS, how: str = "inner", salts: int | None = None) -> DataFrame:
    """Order ⋈ line on the order id, for rows whose event times lie within
    ``bound_s`` seconds of each other (operators 25, 26).

    The reference's bounds are processing-time windows; here they are event
    time, so the result does not depend on arrival speed.  Both sides carry a
    watermark and the time-range condition lets Spark drop join state once
    the watermark has passed ``event time + bound``.  Each (order, line)
    pair is emitted once (D10).  The order side's event time is dropped after
    the join, so stateful steps downstream see one event-time column.

    Streams have no skew handling of their own, so the lines of an order are
    dealt over ``salts`` parts by their id, and the (narrow, fewer) orders are
    copied to each part: a hot order's lines spread over as many tasks, and a
    line still meets its order once.  An outer join is not dealt (``salts`` 1),
    as an order without lines would come out of every part.

    ``how="full_outer"`` (operator 27): rows that met no partner come out, with
    nulls for the other side, when the watermark passes the bound."""
    salts = salts or (JOIN_SALTS if how == "inner" else 1)
    if how != "inner" and salts > 1:
        raise ValueError("only an inner join can deal an order's lines over several parts")
    o = decode_orders(order_values).withColumn("_o_et", F.to_timestamp("create_time")).withWatermark("_o_et", lateness)
    d = decode_details(detail_values).withColumn("_d_et", F.to_timestamp("create_time")).withWatermark("_d_et", lateness)
    # a literal: the planner derives from it how long a row has to be kept
    bound = F.expr(f"interval '{bound_s}' second")
    oo = o.select(
        F.col("id").alias("_oid"), "order_status", F.col("create_time").alias("_o_create_time"), "user_id",
        "benefit_reduce_amount", "original_total_amount", "feight_fee", "final_total_amount", "if_first_order",
        "province_name", "province_area_code", "user_age_group", "user_gender", F.col("create_date").alias("dt"),
        "_o_et", *([F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_o_part")] if salts > 1 else []),
    )
    dd = d.select(
        F.col("id").alias("order_detail_id"), "order_id", "sku_id", F.col("order_price").alias("sku_price"),
        "sku_num", "sku_name", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name", "_d_et",
        *([F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("_d_part")] if salts > 1 else []),
    )
    cond = (
        (dd["order_id"] == oo["_oid"])
        & (dd["_d_et"] >= oo["_o_et"] - bound)
        & (dd["_d_et"] <= oo["_o_et"] + bound)
    )
    if salts > 1:
        cond = (dd["_d_part"] == oo["_o_part"]) & cond
    j = dd.join(oo, cond, how)
    return j.select(
        "order_detail_id", F.coalesce("_oid", "order_id").alias("order_id"), "order_status",
        F.col("_o_create_time").alias("create_time"), "user_id", "sku_id", "sku_price", "sku_num", "sku_name",
        "benefit_reduce_amount", "original_total_amount", "feight_fee", "final_total_amount",
        F.lit(None).cast("decimal(12,2)").alias("final_detail_amount"), "if_first_order", "province_name",
        "province_area_code", "user_age_group", "user_gender", "dt", "spu_id", "tm_id", "category3_id",
        "spu_name", "tm_name", "category3_name", F.col("_d_et").alias("event_time"),
    )


def wide_dedup(wide: DataFrame) -> DataFrame:
    """First wide row per detail id (operator 48): removes the pairs the
    reference's overlapping windows emit twice.  ``wide`` must carry a
    watermarked ``event_time`` (the join's output does); state for an id is
    kept until the watermark passes its event time."""
    return wide.dropDuplicatesWithinWatermark(["order_detail_id"])


def dws_chain(order_values: DataFrame, detail_values: DataFrame, bound_s: int = CACHED_JOIN_BOUND_S,
              lateness: str = DEFAULT_LATENESS, retention_ms: int | None = None) -> DataFrame:
    """The whole wide-order job as one query (operator 53): order ⋈ line, one
    row per line id, paid amount split, each step with its own state; the
    output has the columns of the wide row."""
    wide = wide_dedup(order_detail_join(order_values, detail_values, bound_s, lateness))
    keep = [c for c in orders.ORDER_WIDE_COLUMNS if c != "final_detail_amount"]
    return split_state.split_stream(wide, retention_ms, tuple(keep)).select(*orders.ORDER_WIDE_COLUMNS)


def dws_outputs() -> dict[str, Output]:
    """What a batch of wide rows goes to: the wide table and the next topic.

    The table is stored by batch, not by day: a batch's days lie close
    together, and files sorted by day are skipped by their statistics."""
    return {
        "order_wide": Output(lambda b: b.sortWithinPartitions("dt")),
        "DWS_ORDER_WIDE": Output(lambda b: b.select(F.to_json(F.struct("*")).alias("value")), "text", options={"compression": COMPRESSION}),
    }


# ---- sliding windows --------------------------------------------------------

def sliding_order_windows(order_values: DataFrame, length: str = "10 seconds", slide: str = "5 seconds",
                          lateness: str = DEFAULT_LATENESS) -> DataFrame:
    """Orders and paid totals per event-time window of ``length`` sliding by
    ``slide`` (operator 49).  Partial aggregates per window are kept in state
    until the watermark closes the window."""
    o = decode_orders(order_values).withColumn("_et", F.to_timestamp("create_time")).withWatermark("_et", lateness)
    g = o.groupBy(F.window("_et", length, slide).alias("w")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("final_total_amount").cast("decimal(18,2)")).alias("amount"),
    )
    return g.select(
        F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        F.date_format("w.end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
        "n_orders", "amount",
    )


# ---- CDC fan-out ------------------------------------------------------------

def cdc_fanout(envelopes: DataFrame) -> DataFrame:
    """Row-form change stream -> (topic, data) rows for every target topic
    in one query (operator 51); a sink partitioned by ``topic`` (or Kafka's
    per-row topic) writes all tables at once."""
    return ingest.cdc_rowform_filter(ingest.decode_cdc_row(envelopes)).select("topic", "table", "type", "data")


def cdc_array_fanout(envelopes: DataFrame) -> DataFrame:
    """Array-form change stream -> (topic, table, data) rows, one per element (operator 51)."""
    return ingest.cdc_arrayform_explode(envelopes).select("topic", "table", "data")


# ---- dimensions and enrichment ------------------------------------------------

def dim_upsert_writer(tables: dict[str, DimTable]):
    """``foreachBatch`` function merging (table, data) change rows into the
    dimension tables they name (operator 56); the batch is computed once."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, dim in tables.items():
                rec = jsonx.decode(F.col("data"), dim.schema).alias("r")
                dim.upsert(batch.where(F.col("table") == name).select(rec).select("r.*"), batch_id)
        finally:
            batch.unpersist()

    return run


def order_enrichment(province: DimTable, users: DimTable, as_of: str) -> dict[str, Output]:
    """The DWD order of a batch of order records (operators 21, 22): only the
    users and provinces that the batch names are looked up, as stored now."""

    def rows(batch: DataFrame) -> DataFrame:
        found = dims.user_dim(users.lookup(batch, "user_id"), as_of)
        return orders.dwd_order_info(batch, province.lookup(batch, "province_id"), found)

    return {"dwd_order": Output(rows)}


def detail_enrichment(skus: DimTable) -> dict[str, Output]:
    """The DWD order line of a batch of line records (operator 24)."""
    return {"dwd_detail": Output(lambda batch: orders.dwd_order_detail(batch, skus.lookup(batch, "sku_id")))}


# ---- foreachBatch writers ---------------------------------------------------

def dim_refresh_writer(spark: SparkSession, province_path: str, out_path: str):
    """``foreachBatch`` function joining each order batch with the province
    dimension as it is *now* (operator 52): the dimension is read inside the
    batch function, so a dimension rewritten between two batches is seen by
    the second.  Output rows are written under ``batch_id`` with overwrite
    (a replayed batch replaces its own output)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        province = spark.read.parquet(province_path)
        enriched = orders.join_province(batch, province)
        (enriched.withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out_path))

    return run


def ledger(spark: SparkSession, root: str, group_col: str, amount_col: str, checkpoint: str | None = None):
    """(commits, outputs) of exactly-once per-batch sums (operator 54): each
    micro-batch's sums and the offsets they come from are published together
    (``BatchCommits``), so a batch replayed after a crash counts once."""
    sums = lambda batch: batch.groupBy(F.col(group_col).alias("trademark_name")).agg(
        F.sum(F.col(amount_col).cast("decimal(18,2)")).alias("amount"))
    return BatchCommits(spark, root, checkpoint), {"sums": Output(sums)}


LEDGER_SCHEMA = "trademark_name string, amount decimal(28,2)"


def upsert_writer(out_path: str, key_cols: list[str]):
    """``foreachBatch`` writer for update-mode aggregates: each batch's
    changed rows go under ``batch_id``; readers take, per key, the row of the
    greatest batch id (see ``latest_per_key``)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out_path))

    return run


def latest_per_key(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """Newest version of each key across update batches (an aggregate, so it
    is pre-aggregated per map task)."""
    vals = [c for c in df.columns if c not in key_cols and c != "batch_id"]
    g = df.groupBy(*key_cols).agg(F.max_by(F.struct(*vals), F.col("batch_id")).alias("_v"))
    return g.select(*key_cols, "_v.*")


# ---- running a stream to completion -----------------------------------------

def run_available(stream_writer, name: str, spark: SparkSession, checkpoint: str | None = None):
    """Start ``stream_writer`` (a DataStreamWriter) with ``checkpoint`` (a
    fresh folder under the shared root by default), process everything
    available, and stop.  Re-running with the same checkpoint resumes from
    the committed offsets and keeps the number of partitions its state has."""
    ckpt = checkpoint or scratch_dir(spark, f"ckpt-{name}")
    key = "spark.sql.shuffle.partitions"
    parts = min(int(spark.conf.get(key)), STATE_PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism)
    # the stream takes the session's options as it starts
    with set_for(spark, key, str(parts)), set_for(spark, SHUFFLE_CLEANUP, "true"):
        q = stream_writer.option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {q.exception()}")
    return ckpt
