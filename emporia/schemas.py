"""Record schemas of the reference's messages (typed form; decoding reads
every leaf as text first, see ``functions.jsonx``)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DecimalType(12, 2)


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


COMMON = _st(("mid", S), ("uid", S), ("ar", S), ("ch", S), ("vc", S))

# app log line: {"common": {...}, "start": {...} | absent, "ts": epoch ms}
APP_LOG = _st(("common", COMMON), ("start", S), ("ts", L))

DAU_INFO = _st(("mid", S), ("uid", S), ("ar", S), ("ch", S), ("vc", S), ("dt", S), ("hr", S), ("mi", S), ("ts", L))

CDC_ROW = _st(("table", S), ("type", S), ("data", S))
CDC_ARRAY = _st(("table", S), ("data", T.ArrayType(S)))

ORDER_INFO = _st(
    ("id", L), ("province_id", I), ("order_status", S), ("user_id", L), ("final_total_amount", D),
    ("benefit_reduce_amount", D), ("original_total_amount", D), ("feight_fee", D), ("expire_time", S),
    ("create_time", S), ("operate_time", S), ("create_date", S), ("create_hour", S), ("if_first_order", S),
    ("province_name", S), ("province_area_code", S), ("province_3166_2_code", S), ("user_age_group", S),
    ("user_gender", S),
)

ORDER_DETAIL = _st(
    ("id", L), ("order_id", L), ("sku_id", L), ("order_price", D), ("sku_num", L), ("sku_name", S),
    ("create_time", S), ("spu_id", L), ("tm_id", L), ("category3_id", L), ("spu_name", S), ("tm_name", S),
    ("category3_name", S),
)

ORDER_WIDE = _st(
    ("order_detail_id", L), ("order_id", L), ("order_status", S), ("create_time", S), ("user_id", L),
    ("sku_id", L), ("sku_price", D), ("sku_num", L), ("sku_name", S), ("benefit_reduce_amount", D),
    ("original_total_amount", D), ("feight_fee", D), ("final_total_amount", D), ("final_detail_amount", D),
    ("if_first_order", S), ("province_name", S), ("province_area_code", S), ("user_age_group", S),
    ("user_gender", S), ("dt", S), ("spu_id", L), ("tm_id", L), ("category3_id", L), ("spu_name", S),
    ("tm_name", S), ("category3_name", S),
)

# dimension tables by source table: (key, schema)
DIMENSIONS = {
    "base_province": ("id", _st(("id", I), ("name", S), ("area_code", S), ("iso_code", S), ("iso_3166_2", S))),
    "user_info": ("id", _st(("id", L), ("user_level", S), ("birthday", T.DateType()), ("gender", S))),
    "sku_info": ("id", _st(("id", L), ("spu_id", L), ("price", T.DoubleType()), ("sku_name", S), ("tm_id", L), ("category3_id", I))),
    "spu_info": ("id", _st(("id", L), ("spu_name", S))),
    "base_trademark": ("tm_id", _st(("tm_id", L), ("tm_name", S))),
    "base_category3": ("id", _st(("id", I), ("name", S), ("category2_id", I))),
}

USER_INFO = _st(("id", L), ("user_level", S), ("birthday", S), ("gender", S))
