"""Decoding, routing, CDC filtering and label edge cases."""

from __future__ import annotations

import datetime as dtm

from pyspark.sql import functions as F

from emporia import schemas
from emporia.functions import jsonx
from emporia.functions.labels import AGE_21_TO_30, AGE_OVER_30, AGE_UNDER_20, GENDER_FEMALE, GENDER_MALE
from emporia.operators import dims, ingest


def _values(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_cdc_rowform_filter_edge_cases(spark):
    env = _values(spark, [
        '{"table":"order_info","type":"insert","data":{"id":1}}',          # kept
        '{"table":"order_info","type":"update","data":{"id":2}}',          # order updates dropped
        '{"table":"order_info","type":"insert","data":null}',              # null data
        '{"table":"order_info","type":"insert","data":{}}',                # "{}" is not longer than 2
        '{"table":"order_info","data":{"id":3}}',                          # null type
        '{"table":"sku_info","type":"bootstrap-insert","data":{"id":4}}',  # D3: any bootstrap-insert passes
        '{"table":"sku_info","type":"update","data":{"id":5}}',            # sku updates do not
        '{"table":"base_province","type":"update","data":{"id":"6"}}',     # quoted id
        '{"table":"user_info","type":"delete","data":{"id":7}}',           # deletes do not
    ])
    kept = ingest.cdc_rowform_filter(ingest.decode_cdc_row(env))
    rows = kept.select("topic", F.get_json_object("data", "$.id").cast("long").alias("id")).collect()
    assert sorted((r.topic, r.id) for r in rows) == [
        ("ODS_T_BASE_PROVINCE", 6), ("ODS_T_ORDER_INFO", 1), ("ODS_T_SKU_INFO", 4)]


def test_cdc_arrayform_keeps_element_text(spark):
    env = _values(spark, ['{"table":"order_detail","data":[{"id":1,"sku_num":"2"},{"id":2}]}'])
    rows = ingest.cdc_arrayform_explode(env).collect()
    assert [r.topic for r in rows] == ["ODS_T_ORDER_DETAIL"] * 2
    assert rows[0].data.replace(" ", "") == '{"id":1,"sku_num":"2"}'


def test_decode_accepts_quoted_numbers_and_bad_values(spark):
    df = _values(spark, [
        '{"id":"7","province_id":"3","final_total_amount":"12.50","create_time":"2020-01-01 10:00:00"}',
        '{"id":8,"province_id":3,"final_total_amount":12.5}',
        '{"id":"x9","final_total_amount":"n/a"}',
    ])
    rows = df.select(jsonx.decode(F.col("value"), schemas.ORDER_INFO).alias("r")).select("r.*").collect()
    assert rows[0].id == 7 and rows[0].province_id == 3 and str(rows[0].final_total_amount) == "12.50"
    assert rows[1].id == 8 and str(rows[1].final_total_amount) == "12.50"
    assert rows[2].id is None and rows[2].final_total_amount is None


def test_log_route_and_dt_hr(spark):
    ts = 1704067200000 + 3_600_000 * 5 + 1234  # 2024-01-01 05:00:01.234 UTC
    df = _values(spark, [
        '{"common":{"mid":"m1"},"start":{"entry":"icon"},"ts":%d}' % ts,
        '{"common":{"mid":"m2"},"page":{"id":"home"},"ts":"%d"}' % ts,
    ])
    logs = ingest.with_dt_hr(ingest.route_log(ingest.decode_app_log(df)))
    rows = {r["common"]["mid"]: r for r in logs.collect()}
    assert rows["m1"].topic == "APP_STARTUP" and rows["m2"].topic == "APP_EVENT"
    assert rows["m2"].ts == ts and rows["m1"].dt == "2024-01-01" and rows["m1"].hr == "05"


def test_age_group_boundaries_and_gender(spark):
    as_of = dtm.date(2024, 1, 31)
    def born(years, extra_days=0):
        return as_of - dtm.timedelta(days=365 * years + extra_days)
    users = spark.createDataFrame([
        (1, "1", born(19, 364), "M"), (2, "1", born(20), "F"), (3, "1", born(30, 364), None),
        (4, "1", born(31), "M"), (5, "1", None, "X"),
    ], "id long, user_level string, birthday date, gender string")
    got = {r.id: (r.age_group, r.gender_name) for r in dims.user_dim(users, "2024-01-31").collect()}
    assert got[1] == (AGE_UNDER_20, GENDER_MALE)
    assert got[2] == (AGE_21_TO_30, GENDER_FEMALE)       # exactly 20: middle group (D9)
    assert got[3] == (AGE_21_TO_30, GENDER_FEMALE)       # 30 and a bit: still middle; null gender -> female
    assert got[4] == (AGE_OVER_30, GENDER_MALE)
    assert got[5] == (None, GENDER_FEMALE)


def test_upsert_latest_keeps_newest_change(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    chg = spark.createDataFrame([(1, "x", 5), (1, "y", 9), (3, "z", 1)], "id long, v string, o long")
    got = {r.id: r.v for r in dims.upsert_latest(cur, chg, "id", "o").collect()}
    assert got == {1: "y", 2: "b", 3: "z"}


def test_search_finds_words_of_any_script(spark):
    from emporia.operators.serve import token_match

    rows = spark.createDataFrame([("小米 手机",), ("red phone",), (None,)], "name string")
    assert [r.name for r in rows.where(token_match(F.col("name"), "手机")).collect()] == ["小米 手机"]
