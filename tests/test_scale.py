"""Plans whose cost has to grow no faster than the input: one parse a record,
slices read by ranges of time, compressed topics, narrow shuffles."""

from __future__ import annotations

import json
import os
from types import SimpleNamespace

from pyspark.sql import functions as F

from emporia import schemas
from emporia.functions import jsonx
from emporia.operators import ingest, orders
from emporia.plans import q_streams
from emporia.session import scratch_dir
from emporia.sources.fixtures import Fixtures
from emporia.sources.topics import TopicStore
from emporia.streaming import jobs, split_state
from emporia.streaming.commits import BatchCommits


def _parses(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_json(")


def test_a_record_is_parsed_once_however_many_fields_it_has(spark):
    path = scratch_dir(spark, "t-json")
    texts = [json.dumps({"id": "7", "order_id": 8, "order_price": "1.50", "sku_name": "a"}), "no json", None]
    spark.createDataFrame([(t,) for t in texts], "value string").write.parquet(path)
    rows = spark.read.parquet(path).select(jsonx.decode(F.col("value"), schemas.ORDER_DETAIL).alias("r"))
    assert _parses(rows.select("r.*")) == 1
    got = {(r.r and (r.r.id, r.r.order_id, str(r.r.order_price), r.r.sku_name, r.r.sku_num)) for r in rows.collect()}
    assert got == {(7, 8, "1.50", "a", None), (None, None, "None", None, None), None}


def test_a_change_envelope_is_parsed_once_by_the_filter(spark):
    path = scratch_dir(spark, "t-cdc")
    texts = [json.dumps({"table": "user_info", "type": t, "data": {"id": i}}) for i, t in enumerate(("insert", "delete", "bootstrap-insert"))]
    spark.createDataFrame([(t,) for t in [*texts, "no json", None]], "value string").write.parquet(path)
    decoded = ingest.decode_cdc_row(spark.read.parquet(path))
    assert decoded.columns == ["table", "type", "data"] and decoded.count() == 5
    kept = ingest.cdc_rowform_filter(decoded)
    assert _parses(kept) == 1
    assert sorted(r.data for r in kept.collect()) == ['{"id":0}', '{"id":2}']


def test_a_slice_reads_its_range_of_the_stage(spark, monkeypatch):
    topics, plans = TopicStore(spark), []
    write = TopicStore.write_batch
    monkeypatch.setattr(TopicStore, "write_batch", lambda self, df, *a, **kw: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(self, df, *a, **kw)))
    df = spark.range(6000).select(F.col("id").cast("string").alias("value"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("t"))
    topics.publish_in_slices(df, "R", F.col("t"), 6)
    assert len(plans) == 6 and all("GreaterThan(_t" in p or "LessThanOrEqual(_t" in p for p in plans)
    assert sorted(int(r.value) for r in topics.read_batch("R").collect()) == list(range(6000))


def test_file_topics_are_compressed(spark):
    topics = TopicStore(spark)
    rows = spark.range(5000).select(F.format_string('{"order_detail_id":%d,"sku_name":"a long enough name"}', "id").alias("value"))
    topics.write_batch(rows, "C", files=1)
    topics.write_batch(rows.withColumn("topic", F.lit("D")))
    sizes = [os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(topics.root) for f in fs if f.startswith("part-")]
    text = 5000 * len('{"order_detail_id":1234,"sku_name":"a long enough name"}')
    assert sum(sizes) < text  # half of what the two topics hold as plain text
    assert topics.read_batch("C").count() == 5000 and spark.read.text(f"{topics.root}/topic=D").count() == 5000


def test_only_orders_that_use_their_last_line_carry_its_order(spark, sf_dir):
    plan = Fixtures(spark, sf_dir, store=False).order_info._jdf.queryExecution().optimizedPlan().toString()
    assert "= 6) THEN" in plan.split("max_by(")[1].split(" AS last")[0]


def test_split_state_takes_many_orders_in_one_call():
    assert split_state.PAGE >= 1024


def _files_by_offset(topics, topic):
    return [len(topics.spark.read.text(f"{topics.path(topic)}/offset={i}").inputFiles()) for i in range(topics.end_offset(topic))]


def test_a_slice_is_written_without_a_shuffle_into_its_number_of_files(spark, monkeypatch):
    topics, plans = TopicStore(spark), []
    write = TopicStore.write_batch
    monkeypatch.setattr(TopicStore, "write_batch", lambda self, df, *a, **kw: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(self, df, *a, **kw)))
    # each stage file has a stretch of time of its own: a slice lies in few of them
    df = spark.range(0, 8000, 1, 4).select(F.col("id").cast("string").alias("value"), F.col("id").alias("t"))
    topics.publish_in_slices(df, "F", F.col("t"), 4, rows_per_file=600)
    assert len(plans) == 4 and not any("Exchange" in p for p in plans)
    assert _files_by_offset(topics, "F") == [topics.slice_files["F"]] * 4 == [4] * 4
    seen = []
    jobs.run_available(topics.read_stream("F").writeStream.foreachBatch(lambda b, i: seen.append(b.agg(F.min(F.col("value").cast("long")), F.count("value")).first())), "t-files", spark)
    assert [r[1] for r in seen] == [len(range(*c)) for c in zip([r[0] for r in seen], [*[r[0] for r in seen[1:]], 8000])] and len(seen) == 4


def test_texts_made_of_staged_columns_and_copies_of_a_slice_follow_each_other(spark):
    topics = TopicStore(spark)
    df = spark.range(0, 900, 1, 3).select("id", F.when(F.col("id") % 10 > 0, F.col("id")).alias("v"))
    topics.publish_in_slices(df, "C2", F.col("id"), 3, copies=2, value=F.to_json(F.struct("id", "v")))
    slices = [sorted(json.loads(r.value)["id"] for r in spark.read.text(f"{topics.path('C2')}/offset={i}").collect()) for i in range(6)]
    assert slices[0] == slices[1] and slices[2] == slices[3] and slices[4] == slices[5]
    assert sorted(slices[0] + slices[2] + slices[4]) == list(range(900))
    assert sorted(r.value for r in topics.read_batch("C2").collect())[:2] == ['{"id":0}'] * 2


def test_a_stream_has_few_state_partitions_and_leaves_the_session_as_it_was(spark):
    topics, key = TopicStore(spark), "spark.sql.shuffle.partitions"
    topics.write_batch(spark.createDataFrame([("a",), ("b",)], "value string"), "P", files=1)
    old = spark.conf.get(key)
    spark.conf.set(key, "200")
    try:
        counts = topics.read_stream("P").groupBy("value").count()
        ckpt = jobs.run_available(counts.writeStream.outputMode("update").format("parquet").foreachBatch(lambda b, i: b.count()), "t-parts", spark)
        assert spark.conf.get(key) == "200"
    finally:
        spark.conf.set(key, old)
    meta = json.loads(spark.read.text(f"{ckpt}/offsets/0").collect()[1].value)
    assert int(meta["conf"][key]) <= 2 * spark.sparkContext.defaultParallelism


def test_orders_and_lines_are_cut_at_the_same_times(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(TopicStore, "publish_in_slices", lambda self, df, topic, *a, **kw: (calls.append((topic, kw)), [1.0, 2.0])[1])
    frame = spark.createDataFrame([(1, "2024-01-01 10:00:00")], "id long, create_time string")
    q_streams._publish_orders_details(spark, SimpleNamespace(order_info=frame, order_detail=frame), detail_copies=2)
    assert calls == [("DWD_ORDER_DETAIL", {"copies": 2}), ("DWD_ORDER_INFO", {"cuts": [1.0, 2.0]})]


def test_the_wide_topic_is_compressed(spark, tmp_path):
    wide = spark.range(2000).select(*[F.lit(1).alias(c) if c != "order_id" else F.col("id").alias(c) for c in orders.ORDER_WIDE_COLUMNS])
    BatchCommits(spark, str(tmp_path)).write(wide, 0, jobs.dws_outputs())
    sizes = [os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(tmp_path / "DWS_ORDER_WIDE") for f in fs if f.startswith("part-")]
    assert 0 < sum(sizes) < 2000 * 100
