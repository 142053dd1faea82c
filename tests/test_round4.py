"""Plans and state whose cost the round-4 findings were about."""

from __future__ import annotations

import json
import os
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from emporia import schemas
from emporia.functions import jsonx
from emporia.operators import orders
from emporia.plans import q_streams
from emporia.plans.warehouse import Warehouse
from emporia.session import SHUFFLE_CLEANUP, scratch_dir, set_for
from emporia.sources import messages
from emporia.sources.fixtures import Fixtures
from emporia.sources.topics import TopicStore
from emporia.streaming import jobs, split_state


def _parses(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_json(")


def _texts(spark, texts):
    path = scratch_dir(spark, "t-texts")
    spark.createDataFrame([(t,) for t in texts], "value string").write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("decode", [jobs.decode_orders, jobs.decode_details])
def test_a_filter_on_a_decoded_field_parses_no_text_again(spark, decode):
    rows = decode(_texts(spark, ['{"id":"7","create_time":"2024-01-01 10:00:00"}', '{"id":null}', "no json", None]))
    kept = rows.where(F.col("id").isNotNull() & F.to_timestamp("create_time").isNotNull())
    assert _parses(kept) == 1
    assert [(r.id, r.create_time) for r in kept.collect()] == [(7, "2024-01-01 10:00:00")] and rows.count() == 4


def test_records_are_what_decode_gives(spark):
    texts = ['{"id":"7","order_id":8,"order_price":"1.50","sku_name":"a","sku_num":"x"}', '{"id":[1]}', "[]", "no json", "", None]
    rows = _texts(spark, texts)
    want = rows.select(jsonx.decode(F.col("value"), schemas.ORDER_DETAIL).alias("r")).select("r.*")
    got = jsonx.records(rows, "value", schemas.ORDER_DETAIL)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    some = jsonx.records(rows, "value", schemas.ORDER_DETAIL, ("id", "sku_name"), keep=("value",))
    assert some.columns == ["value", "id", "sku_name"] and {(r.id, r.sku_name) for r in some.collect()} == {(7, "a"), (None, None)}
    # a nested record, too
    log = _texts(spark, [json.dumps({"common": {"mid": "m"}, "ts": "5"}), json.dumps({"ts": 6}), "no json"])
    nested = sorted(map(tuple, jsonx.records(log, "value", schemas.APP_LOG).collect()), key=repr)
    assert nested == sorted(map(tuple, log.select(jsonx.decode(F.col("value"), schemas.APP_LOG).alias("r")).select("r.*").collect()), key=repr)


def test_a_page_of_the_split_state_is_packed_and_only_its_batchs_orders_are_unpacked():
    assert split_state.STATE_SCHEMA["page"].dataType.typeName() == "binary"
    page = split_state._page_of(None)
    for new in ({5: (1, 2, 3), 9: (-4, 0, 1)}, {7: (10, 11, 1), 5: (6, 6, 4)}, {1: (0, 0, 1), 2**40: (2**50, 1, 1)}):
        page = split_state._page_of(split_state._with_numbers(page, new).tobytes())
    assert page[0].tolist() == [1, 5, 7, 9, 2**40]
    assert split_state._numbers_of(page, np.array([0, 5, 6, 9, 2**40, 2**41])) == {5: (6, 6, 4), 9: (-4, 0, 1), 2**40: (2**50, 1, 1)}
    assert split_state._numbers_of(split_state._page_of(None), np.array([5])) == {}


def test_a_batch_that_touches_every_page_makes_few_calls():
    # pages times batches: neighbouring ids of a million orders in no more than 128 state rows
    assert 1_000_000 / split_state.PAGE <= 128


def test_wide_rows_are_not_shuffled_after_the_split(spark, sf_dir):
    with set_for(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        plan = Warehouse(spark, sf_dir).wide._jdf.queryExecution().executedPlan().toString()
    above = plan.split("Union")[0]
    assert "Union" in plan and "hashpartitioning(user_id" not in above and "hashpartitioning(sku_id" not in above


def test_carried_user_and_sku_rows_give_the_wide_rows_of_joins_after_the_split(spark):
    # keys that are null, unknown, and there twice
    o = spark.sql("select *, cast('2024-01-01 10:00:00' as timestamp) create_time from values (1L, 10L, 3), (2L, 11L, 4), (3L, null, null), (4L, 12L, 3) as t(id, user_id, province_id)")
    o = o.select("*", *[F.lit(1).cast("decimal(12,2)").alias(c) for c in ("benefit_reduce_amount", "original_total_amount", "feight_fee", "final_total_amount")], F.lit("x").alias("order_status"))
    d = spark.sql("select *, cast(1 as decimal(12,2)) order_price, 1 sku_num, 'n' sku_name from values (1L, 1L, 100L), (2L, 1L, null), (3L, 2L, 101L), (4L, 3L, 100L), (5L, 4L, 102L) as t(id, order_id, sku_id)")
    users = spark.sql("select * from values (10L, 'M', 'a'), (10L, 'F', 'b'), (11L, null, null), (null, 'M', 'c') as t(id, gender_name, age_group)")
    skus = spark.sql("select *, 'k' category3_name from values (100L, 1L, 2L, 3, 's', 't'), (101L, 1L, null, 3, 's', null), (101L, 1L, null, 3, 's', null), (null, 9L, 9L, 9, 's', 't') as t(id, spu_id, tm_id, category3_id, spu_name, tm_name)")
    province = spark.sql("select * from values (3, 'P', 'a', 'i', 'j'), (3, 'Q', 'a', 'i', 'j') as t(id, name, area_code, iso_code, iso_3166_2)")
    carried = orders.order_lines(orders.with_user_rows(o, users), orders.with_sku_rows(d, skus), (orders.USER_ATTRIBUTES, orders.SKU_ATTRIBUTES))
    got, want = orders.unfolded(carried, province), orders.widened(orders.order_lines(o, d), province, users, skus)
    assert got.schema.simpleString() == want.schema.simpleString()
    rows = [sorted(map(tuple, f.collect()), key=repr) for f in (got, want)]
    assert rows[0] == rows[1] and len(rows[0]) > 5


def _files(root):
    return [f for _, _, fs in os.walk(root) for f in fs]


def test_a_published_topics_stage_is_removed(spark, monkeypatch):
    stages = []
    monkeypatch.setattr("emporia.sources.topics.scratch_dir", lambda s, n: (stages.append(scratch_dir(s, n)), stages[-1])[1])
    topics = TopicStore(spark)
    topics.publish_in_slices(spark.range(100).select(F.col("id").cast("string").alias("value"), "id"), "S", F.col("id"), 3)
    stage = next(s for s in stages if "stage-S" in s)
    assert not os.path.exists(stage) and _files(topics.path("S")) and topics.read_batch("S").count() == 100


def test_sources_are_stored_with_their_shuffle_files_removed(spark, monkeypatch):
    seen, df = [], spark.range(1)
    monkeypatch.setattr("emporia.sources.fixtures.app_id", lambda s: scratch_dir(s, "app"))
    Fixtures(spark, "nowhere")._stored("t", lambda: (seen.append(spark.conf.get(SHUFFLE_CLEANUP, None)), df)[1])
    assert seen == ["true"] and spark.conf.get(SHUFFLE_CLEANUP, None) != "true"


def test_the_chain_sends_lines_twice_without_staging_them_twice_and_cuts_by_them(spark, monkeypatch):
    calls = []

    class Stop(Exception):
        pass

    def publish(self, df, topic, *a, **kw):
        calls.append((topic, df.count(), kw))
        if len(calls) == 2:
            raise Stop
        return [1.0]

    monkeypatch.setattr(TopicStore, "publish_in_slices", publish)
    o = spark.createDataFrame([(1, "2024-01-01 10:00:00")], "id long, create_time string")
    d = spark.createDataFrame([(1, 1, "2024-01-01 10:00:01"), (2, 1, "2024-01-01 10:00:01")], "id long, order_id long, create_time string")
    monkeypatch.setattr(q_streams.Warehouse, "of", lambda *a: SimpleNamespace(order_info=o, order_detail=d))
    with pytest.raises(Stop):
        q_streams.st_dws_chain(spark, "nowhere")
    assert calls == [("DWD_ORDER_DETAIL", 2, {"copies": 2}), ("DWD_ORDER_INFO", 1, {"cuts": [1.0]})]


def test_change_envelopes_are_put_together_without_a_format_string(spark, sf_dir, monkeypatch):
    rows = spark.createDataFrame([("user_info", "insert", 1, '{"id":1}'), ("sku_info", None, None, None)], "table string, type string, id long, data string")
    monkeypatch.setattr(messages, "cdc_change_rows", lambda fx: rows)
    env = messages.cdc_row_envelopes(None)
    assert [r.value for r in env.collect()] == ['{"table":"user_info","type":"insert","data":{"id":1}}', '{"table":"sku_info","type":"null","data":null}']
    assert "format_string" not in env._jdf.queryExecution().optimizedPlan().toString()
