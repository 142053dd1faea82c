"""Raw messages derived from the fixtures: app-log lines and CDC envelopes.

The reference's inputs are JSON texts on topics.  These builders produce the
same texts from the driver's tables (a Spark job each), so that decoding,
routing and filtering run on real volumes.  Numbers of every third record
are written quoted, the form the reference's parser accepts and ours must.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions.timefmt import as_text
from emporia.sources.fixtures import Fixtures

# CDC envelope fixture rule (fixed): change type by id % 10.
CDC_TYPE_BY_ID_MOD_10 = (
    "insert", "insert", "insert", "insert", "insert", "insert",
    "update", "update", "delete", "bootstrap-insert",
)
# array-form envelopes carry up to this many rows (ids id//4*4 .. +3)
CDC_ARRAY_GROUP = 4


def app_log_lines(fx: Fixtures) -> DataFrame:
    """One JSON log line per app event: ``common`` (mid, uid, ar, ch, vc),
    ``start`` (only for startups) and ``ts``; plus ``event_id``/``ts`` columns
    for bucketing the lines into topic files."""
    s = fx.startup_log
    common = F.struct("mid", "uid", "ar", "ch", "vc").alias("common")
    start = F.when(F.col("start_entry").isNotNull(), F.struct(F.col("start_entry").alias("entry"))).alias("start")
    value = F.to_json(F.struct(common, start, F.col("ts").alias("ts")))
    return s.select(value.alias("value"), "event_id", "ts")


def _json_with_quoted_numbers(df: DataFrame, key: str, *carry: str, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """``to_json`` of each row; rows with ``key % 3 == 0`` get every field
    quoted (strings), the rest keep JSON numbers.  ``carry`` columns are kept
    beside the text, columns in ``leave_out`` are not part of it."""
    names = [n for n in df.columns if n not in leave_out]
    quoted = F.to_json(F.struct(*[F.col(n).cast("string").alias(n) for n in names]))
    plain = F.to_json(F.struct(*names))
    return df.select(F.when(F.col(key) % 3 == 0, quoted).otherwise(plain).alias("value"), F.col(key).alias("_key"),
                     *carry)


def _texted(df: DataFrame) -> DataFrame:
    out = []
    for name, dtype in df.dtypes:
        if dtype.startswith("timestamp"):
            out.append(as_text(F.col(name)).alias(name))
        elif dtype == "date":
            out.append(F.col(name).cast("string").alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def cdc_sources(fx: Fixtures) -> list[tuple[str, DataFrame]]:
    """(source table name, rows) for the tables that send change records."""
    return [
        ("order_info", fx.order_info),
        ("order_detail", fx.order_detail),
        ("base_province", fx.province),
        ("user_info", fx.user_info),
        ("sku_info", fx.sku),
    ]


def cdc_change_rows(fx: Fixtures) -> DataFrame:
    """(table, type, id, data) for every fixture row; ``data`` is the row's
    JSON text, ``type`` follows ``CDC_TYPE_BY_ID_MOD_10``."""
    types = F.array(*[F.lit(t) for t in CDC_TYPE_BY_ID_MOD_10])
    parts = []
    for name, df in cdc_sources(fx):
        j = _json_with_quoted_numbers(_texted(df), "id")
        parts.append(
            j.select(
                F.lit(name).alias("table"),
                F.element_at(types, (F.col("_key") % 10 + 1).cast("int")).alias("type"),
                F.col("_key").cast("long").alias("id"),
                F.col("value").alias("data"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dim_sources(fx: Fixtures) -> list[tuple[str, DataFrame, str, str]]:
    """(source table, rows, key, a text column that changes) of the six dimensions."""
    return [
        ("base_province", fx.province, "id", "name"), ("user_info", fx.user_info, "id", "user_level"), ("sku_info", fx.sku, "id", "sku_name"),
        ("spu_info", fx.spu, "id", "spu_name"), ("base_trademark", fx.trademark, "tm_id", "tm_name"), ("base_category3", fx.category3, "id", "name"),
    ]


def dim_change_envelopes(fx: Fixtures) -> DataFrame:
    """Array-form envelopes with two or three changes of every dimension row,
    each with its offset ``xid``: an old value, the row, and for every fifth
    key one more value.  Every third key's old value is sent last (``sent``)."""
    parts = []
    for name, df, key, text in dim_sources(fx):
        k, value = F.col(key).cast("long"), F.col(text)
        changes = F.filter(F.array(
            F.struct(F.lit(1).alias("xid"), F.concat(F.lit("old "), value).alias("v")), F.struct(F.lit(2).alias("xid"), value.alias("v")),
            F.struct(F.when(k % 5 == 0, 3).alias("xid"), F.concat(value, F.lit(" v2")).alias("v")),
        ), lambda c: c.xid.isNotNull())
        rows = _texted(df).withColumn("c", F.explode(changes))
        data = F.to_json(F.struct(*[F.col("c.v").alias(c) if c == text else F.col(c) for c in df.columns], F.col("c.xid").alias("xid")))
        sent = F.when((k % 3 == 0) & (F.col("c.xid") == 1), 4).otherwise(F.col("c.xid"))
        each = rows.select(F.lit(name).alias("table"), F.floor(k / CDC_ARRAY_GROUP).alias("grp"), sent.alias("sent"), k.alias("id"), data.alias("data"))
        grouped = each.groupBy("table", "grp", "sent").agg(F.sort_array(F.collect_list(F.struct("id", "data"))).alias("rows"))
        value = F.format_string('{"table":"%s","data":[%s]}', F.col("table"), F.array_join(F.transform("rows", lambda r: r["data"]), ","))
        parts.append(grouped.select(value.alias("value"), "sent"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cdc_row_envelopes(fx: Fixtures) -> DataFrame:
    """Row-form envelopes ``{"table", "type", "data": {...}}`` as text."""
    ch = cdc_change_rows(fx)
    # table names and change types are plain identifiers: no escaping needed.
    # Concatenated: a format string is read anew for every row
    part = lambda c: F.coalesce(F.col(c), F.lit("null"))
    value = F.concat(F.lit('{"table":"'), part("table"), F.lit('","type":"'), part("type"), F.lit('","data":'), part("data"), F.lit("}"))
    return ch.select(value.alias("value"), "table", "type", "id")


def cdc_array_envelopes(fx: Fixtures) -> DataFrame:
    """Array-form envelopes ``{"table", "data": [{...}, ...]}`` holding up to
    ``CDC_ARRAY_GROUP`` consecutive ids each (a bounded group)."""
    ch = cdc_change_rows(fx)
    grp = ch.groupBy("table", F.floor(F.col("id") / CDC_ARRAY_GROUP).alias("grp")).agg(
        F.sort_array(F.collect_list(F.struct("id", "data"))).alias("rows")
    )
    value = F.format_string(
        '{"table":"%s","data":[%s]}', F.col("table"), F.array_join(F.transform("rows", lambda r: r["data"]), ",")
    )
    return grp.select(value.alias("value"), "table", "grp")
