"""Ingest operators: app-log decoding and routing, CDC envelope filtering and
fan-out, date/hour projection, DAU record shape (operators 2, 7, 9, 13, 16-18).

All stateless ``DataFrame -> DataFrame`` functions over a ``value`` column of
JSON text, so the same code runs on a batch read and on a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia import schemas
from emporia.functions import jsonx
from emporia.functions.labels import TOPIC_EVENT, TOPIC_STARTUP, cdc_topic
from emporia.functions.timefmt import dt_from_millis, hr_from_millis


def decode_app_log(lines: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw log line -> ``common`` struct, ``start`` (JSON text or null), ``ts``
    (plus the ``keep`` columns of the input, e.g. the message offset)."""
    rec = jsonx.decode(F.col(value), schemas.APP_LOG).alias("r")
    return lines.select(*keep, rec).select(*keep, "r.common", "r.start", "r.ts")


def route_log(logs: DataFrame) -> DataFrame:
    """Startup logs (non-empty ``start``) to the startup topic, the rest to
    the event topic (operator 16).  The topic is a column, so one sink writes
    both (Kafka's per-row ``topic``, or ``partitionBy('topic')`` on files)."""
    is_start = F.coalesce(F.length(F.col("start")) > 0, F.lit(False))
    return logs.withColumn("topic", F.when(is_start, F.lit(TOPIC_STARTUP)).otherwise(F.lit(TOPIC_EVENT)))


def with_dt_hr(logs: DataFrame) -> DataFrame:
    """``dt`` (yyyy-MM-dd) and ``hr`` (HH) from the epoch-ms ``ts`` (operator 7)."""
    return logs.withColumn("dt", dt_from_millis(F.col("ts"))).withColumn("hr", hr_from_millis(F.col("ts")))


def dau_info(logs: DataFrame) -> DataFrame:
    """Flatten ``common.*`` into the DAU document; ``mi`` is the constant
    ``"00"`` (operator 9).  Expects ``dt``/``hr`` columns."""
    return logs.select(
        F.col("common.mid").alias("mid"), F.col("common.uid").alias("uid"), F.col("common.ar").alias("ar"),
        F.col("common.ch").alias("ch"), F.col("common.vc").alias("vc"), "dt", "hr", F.lit("00").alias("mi"), "ts",
    )


# ---- CDC ----------------------------------------------------------------

def decode_cdc_row(envelopes: DataFrame, value: str = "value") -> DataFrame:
    """Row-form envelope text -> ``table``, ``type``, ``data`` (object as text).

    A row generator: a filter on its columns stays above it, so the text is
    parsed once and not again for every column that the filter names."""
    return envelopes.select(F.inline_outer(F.array(F.from_json(F.col(value), schemas.CDC_ROW))))


def cdc_rowform_filter(env: DataFrame) -> DataFrame:
    """Keep the change rows the downstream jobs consume, with the target topic
    (operators 13, 17): initial loads of any table, new rows of the two order
    tables, and new or changed rows of provinces and users (D3)."""
    table, typ, data = F.col("table"), F.col("type"), F.col("data")
    wanted_types = (
        F.when(table.isin("order_info", "order_detail"), F.array(F.lit("insert")))
        .when(table.isin("base_province", "user_info"), F.array(F.lit("insert"), F.lit("update")))
        .otherwise(F.array().cast("array<string>"))
    )
    keep = (F.length(data) > 2) & ((typ == "bootstrap-insert") | F.array_contains(wanted_types, typ))
    return env.where(F.coalesce(keep, F.lit(False))).withColumn("topic", cdc_topic(table))


def cdc_arrayform_explode(envelopes: DataFrame, value: str = "value") -> DataFrame:
    """Array-form envelope -> one row per element of ``data``, the element's
    JSON text kept as is, with the target topic (operator 18).  No type
    filter, as in the reference."""
    e = F.from_json(F.col(value), schemas.CDC_ARRAY).alias("e")
    rows = envelopes.select(e).select("e.table", F.explode("e.data").alias("data"))
    return rows.withColumn("topic", cdc_topic(F.col("table")))
