"""Stream behaviour the batch oracle cannot show: lateness bounds, dimension
refresh between batches, replayed batches, out-of-order lines."""

from __future__ import annotations

import json
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from emporia.session import scratch_dir
from emporia.sources.topics import TopicStore
from emporia.streaming import jobs, split_state


def _order(oid, t, amount="10.00"):
    return json.dumps({"id": oid, "province_id": 1, "order_status": "1", "user_id": 1, "final_total_amount": amount,
                       "original_total_amount": amount, "create_time": t, "create_date": t[:10]})


def _detail(did, oid, t):
    return json.dumps({"id": did, "order_id": oid, "sku_id": 1, "order_price": "10.00", "sku_num": 1,
                       "create_time": t})


def _publish(spark, topics, topic, values):
    topics.write_batch(spark.createDataFrame([(v,) for v in values], "value string"), topic, files=1)


def test_stream_join_keeps_late_rows_within_bound_and_drops_very_late(spark):
    topics = TopicStore(spark)
    # batch 1: order 1 at 10:00:00 with a line 5 s later (joins)
    _publish(spark, topics, "O", [_order(1, "2024-01-01 10:00:00"), _order(2, "2024-01-01 10:30:00")])
    _publish(spark, topics, "D", [_detail(11, 1, "2024-01-01 10:00:05")])
    # batch 2: time moves 3 h on, the watermark (1 h lateness) passes order 1
    _publish(spark, topics, "O", [_order(3, "2024-01-01 13:00:00")])
    _publish(spark, topics, "D", [_detail(31, 3, "2024-01-01 13:00:01")])
    # batch 3: time moves on; at its end the state of order 1 is evicted
    _publish(spark, topics, "O", [_order(4, "2024-01-01 13:00:30")])
    _publish(spark, topics, "D", [_detail(41, 4, "2024-01-01 13:00:31")])
    # batch 4: a line of order 1 within 10 s of it, but far behind the
    # watermark -> no partner left, dropped; a line of order 3 that is 8 s
    # after it and within the lateness -> joins
    _publish(spark, topics, "O", [_order(5, "2024-01-01 13:01:00")])
    _publish(spark, topics, "D", [_detail(12, 1, "2024-01-01 10:00:08"), _detail(32, 3, "2024-01-01 13:00:08")])
    j = jobs.order_detail_join(topics.read_stream("O"), topics.read_stream("D"), 10)
    out = scratch_dir(spark, "t-join")
    jobs.run_available(j.select("order_detail_id", "order_id").writeStream.format("parquet").option("path", out),
                       "t-join", spark)
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert got == [(11, 1), (31, 3), (32, 3), (41, 4)]


def test_dimension_is_reread_every_batch(spark):
    topics = TopicStore(spark)
    prov = scratch_dir(spark, "t-prov")
    spark.createDataFrame([(1, "OLD", "100", "CN-1", "CN-P1")], "id int, name string, area_code string, "
                          "iso_code string, iso_3166_2 string").write.parquet(prov)
    out, ckpt = scratch_dir(spark, "t-dimref"), scratch_dir(spark, "t-dimref-ckpt")

    def run():
        s = jobs.decode_orders(topics.read_stream("O")).select("id", "province_id")
        jobs.run_available(s.writeStream.foreachBatch(jobs.dim_refresh_writer(spark, prov, out)), "t-dimref",
                           spark, checkpoint=ckpt)

    _publish(spark, topics, "O", [_order(1, "2024-01-01 10:00:00")])
    run()
    spark.createDataFrame([(1, "NEW", "100", "CN-1", "CN-P1")], "id int, name string, area_code string, "
                          "iso_code string, iso_3166_2 string").write.mode("overwrite").parquet(prov)
    _publish(spark, topics, "O", [_order(2, "2024-01-01 10:00:01")])
    run()
    got = {r.id: r.province_name for r in spark.read.parquet(out).collect()}
    assert got == {1: "OLD", 2: "NEW"}


def test_split_stream_shares_add_up_with_lines_in_two_batches(spark):
    topics = TopicStore(spark)
    def wide(did, t):
        return json.dumps({"order_detail_id": did, "order_id": 1, "create_time": t, "sku_price": "10.00", "sku_num": 1,
                           "original_total_amount": "30.00", "final_total_amount": "20.00", "dt": t[:10]})
    # the last line (by id) arrives first; the completing line is then the
    # last one to arrive, as in the reference
    _publish(spark, topics, "W", [wide(3, "2024-01-01 10:00:00")])
    _publish(spark, topics, "W", [wide(1, "2024-01-01 10:00:01"), wide(2, "2024-01-01 10:00:02")])
    from emporia import schemas
    from emporia.functions import jsonx
    s = topics.read_stream("W").select(jsonx.decode(F.col("value"), schemas.ORDER_WIDE).alias("r")).select("r.*")
    s = s.withColumn("event_time", F.to_timestamp("create_time")).withWatermark("event_time", "1 hour")
    out = scratch_dir(spark, "t-split")
    jobs.run_available(split_state.split_stream(s).writeStream.format("parquet").option("path", out), "t-split",
                       spark)
    got = {r.order_detail_id: r.final_detail_amount for r in spark.read.parquet(out).collect()}
    assert got == {3: Decimal("6.67"), 1: Decimal("6.67"), 2: Decimal("6.66")}
    assert sum(got.values()) == Decimal("20.00")


def _wide(did, oid, t, price, gross, paid):
    return json.dumps({"order_detail_id": did, "order_id": oid, "create_time": t, "sku_price": price, "sku_num": 1,
                       "original_total_amount": gross, "final_total_amount": paid, "dt": t[:10]})


def _run_split(spark, topics, out, ckpt=None, **kw):
    from emporia import schemas
    from emporia.functions import jsonx
    s = topics.read_stream("W").select(jsonx.decode(F.col("value"), schemas.ORDER_WIDE).alias("r")).select("r.*")
    s = s.withColumn("event_time", F.to_timestamp("create_time")).withWatermark("event_time", "1 hour")
    jobs.run_available(split_state.split_stream(s, **kw).writeStream.format("parquet").option("path", out), "t-split2",
                       spark, checkpoint=ckpt)
    return {r.order_detail_id: r.final_detail_amount for r in spark.read.parquet(out).collect()}


def test_split_stream_of_a_large_order_is_exact(spark):
    topics = TopicStore(spark)
    _publish(spark, topics, "W", [_wide(1, 1, "2024-01-01 10:00:00", "50000000.00", "90000000.00", "80000000.00"),
                                  _wide(2, 1, "2024-01-01 10:00:00", "40000000.00", "90000000.00", "80000000.00")])
    assert _run_split(spark, topics, scratch_dir(spark, "t-big")) == {1: Decimal("44444444.44"), 2: Decimal("35555555.56")}


def test_split_stream_restarts_with_other_partitions_and_takes_very_late_lines(spark):
    topics = TopicStore(spark)
    out, ckpt = scratch_dir(spark, "t-re"), scratch_dir(spark, "t-re-ckpt")
    orders = range(1, 21)
    _publish(spark, topics, "W", [_wide(i * 10 + 1, i, "2024-01-01 10:00:00", "10.00", "30.00", "20.00") for i in orders])
    # another order moves time on by a day
    _publish(spark, topics, "W", [_wide(9001, 900, "2024-01-02 10:00:00", "5.00", "5.00", "5.00")])
    _run_split(spark, topics, out, ckpt)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(int(before) + 3))
    try:
        _publish(spark, topics, "W", [_wide(i * 10 + k, i, "2024-01-01 10:00:01", "10.00", "30.00", "20.00")
                                      for i in orders for k in (2, 3)])
        got = _run_split(spark, topics, out, ckpt)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for i in orders:
        assert [got[i * 10 + k] for k in (1, 2, 3)] == [Decimal("6.67"), Decimal("6.67"), Decimal("6.66")]


def _lines(rows):
    """(order, line, known, o, t, f, raw or None) rows as the arrays of split_lines."""
    cols = list(zip(*rows))
    raw = np.array([0 if r is None else r for r in cols[6]], np.int64)
    return [*(np.array(c, np.int64) for c in cols[:2]), np.array(cols[2], bool), *(np.array(c, np.int64) for c in cols[3:6]), raw, np.array([r is not None for r in cols[6]])]


def test_split_lines_of_one_order_many_of_them_zero():
    rows = [(7, i, True, 50 if i < 2 else 0, 100, 99, 50 if i < 2 else 0) for i in reversed(range(100_000))]
    by, shares, state = split_state.split_lines(*_lines(rows), {})
    assert [rows[i][1] for i in by[:3]] == [0, 1, 2]
    assert shares[:3] == [50, 49, 0] and state == {7: (100, 99, 100_000)}


@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-2, 3), st.booleans(), st.integers(-1, 4)), max_size=30), st.integers(1, 4))
@settings(max_examples=200, deadline=None)
def test_split_lines_equal_the_rule_line_by_line(lines, batches):
    rows = [(o, i, known, gross, (6, 0, 4)[o], 7 * o, None if raw < 0 else raw) for i, (o, gross, known, raw) in enumerate(lines)]
    state, got = {}, {}
    for b in range(batches):
        part = rows[b::batches]
        if part:
            by, shares, new = split_state.split_lines(*_lines(part), state)
            state |= new
            got |= {part[i][1]: s for i, s in zip(by, shares)}
    sums, want = {}, {}
    for b in range(batches):
        for o, i, known, gross, t, f, raw in sorted(rows[b::batches]):
            acc, paid, seen = sums.get(o, (0, 0, 0))
            acc += gross
            want[i] = f - paid if known and t == (acc if seen else 0) else raw
            sums[o] = (acc, paid + (want[i] or 0), seen + 1)
    assert got == want and state == sums


def test_split_stream_with_retention_evicts_and_still_splits(spark):
    topics = TopicStore(spark)
    _publish(spark, topics, "W", [_wide(11, 1, "2024-01-01 10:00:00", "10.00", "30.00", "20.00")])
    _publish(spark, topics, "W", [_wide(12, 1, "2024-01-01 10:30:00", "10.00", "30.00", "20.00"),
                                  _wide(13, 1, "2024-01-01 10:30:00", "10.00", "30.00", "20.00")])
    _publish(spark, topics, "W", [_wide(9001, 900, "2024-01-02 10:00:00", "5.00", "5.00", "5.00")])
    got = _run_split(spark, topics, scratch_dir(spark, "t-ret"), retention_ms=3_600_000)
    assert got == {11: Decimal("6.67"), 12: Decimal("6.67"), 13: Decimal("6.66"), 9001: Decimal("5.00")}


def test_publish_in_slices_keeps_every_row_in_equal_files_per_slice(spark):
    topics = TopicStore(spark)
    # one time holds two thirds of the rows; some rows have no time
    df = spark.range(3000).select(F.col("id").cast("string").alias("value"),
                                  F.when(F.col("id") < 2000, 7).when(F.col("id") < 2990, F.col("id")).alias("t"))
    topics.publish_in_slices(df, "P", F.col("t"), 6, rows_per_file=500)
    assert topics.slice_files["P"] == 5
    out = scratch_dir(spark, "t-pub")
    sizes = []
    jobs.run_available(topics.read_stream("P").writeStream.foreachBatch(
        lambda b, i: (sizes.append(b.count()), b.write.mode("append").parquet(out))), "t-pub", spark)
    assert sizes[0] >= 2000 and len(sizes) > 1
    assert sorted(int(r.value) for r in spark.read.parquet(out).collect()) == list(range(3000))
    topics.publish_in_slices(df.limit(0), "E", F.col("t"), 6)
    assert topics.read_batch("E").count() == 0


def _log(mid, ts, ch="view"):
    return json.dumps({"common": {"mid": mid, "uid": "1", "ar": "A", "ch": ch, "vc": "v1"},
                       "start": {"entry": "icon"}, "ts": ts})


DAY = 1704067200000  # 2024-01-01 00:00:00 UTC


def test_dau_aggregate_stream_keeps_earliest_record_when_it_arrives_later(spark):
    from emporia.sinks.daily import DailyDocs

    topics = TopicStore(spark)
    _publish(spark, topics, "L", [_log("m1", DAY + 600_000, "late"), _log("m2", DAY + 5_000)])
    # the earlier record of m1 arrives in the next batch (within the lateness)
    _publish(spark, topics, "L", [_log("m1", DAY + 60_000, "early"), _log("m2", DAY + 9_000)])
    sink = DailyDocs(spark, scratch_dir(spark, "t-dau"))
    jobs.run_available(jobs.dau_first_visit_stream(topics.read_stream("L")).writeStream.outputMode("update")
                       .foreachBatch(sink.write), "t-dau", spark)
    got = {r.mid: (r.ch, r.ts, r.dt, r.hr) for r in sink.read().collect()}
    assert got == {"m1": ("early", DAY + 60_000, "2024-01-01", "00"), "m2": ("view", DAY + 5_000, "2024-01-01", "00")}


def test_file_topic_starts_at_the_given_offset(spark):
    topics = TopicStore(spark)
    for i in range(4):
        _publish(spark, topics, "S", [f"v{i}"])

    def read(start, later=None):
        out, ckpt = scratch_dir(spark, "t-offset"), scratch_dir(spark, "t-offset-ckpt")
        stream = topics.read_stream("S", starting_offsets=start)
        if later:
            _publish(spark, topics, "S", [later])
        jobs.run_available(stream.writeStream.format("parquet").option("path", out), "t-offset", spark, ckpt)
        return sorted(r.value for r in spark.read.schema("value string").parquet(out).collect())

    assert read("earliest") == ["v0", "v1", "v2", "v3"] and read(0) == read("earliest") and read(2) == ["v2", "v3"]
    assert read("latest", later="v4") == ["v4"]
    # another store over the same folder finds the end itself
    assert TopicStore(spark, root=topics.root).end_offset("S") == 5
    for bad in (6, -1, "newest", "1", None):
        with pytest.raises(ValueError):
            topics.read_stream("S", starting_offsets=bad)
    rows = spark.read.schema("value string, offset long").text(topics.path("S")).where("offset >= 3")
    assert "PartitionFilters: [isnotnull(offset" in rows._jdf.queryExecution().executedPlan().toString()


def test_rows_of_one_day_read_one_folder(spark):
    from emporia.sinks.writers import append_by_day, read_day_partitioned

    path = scratch_dir(spark, "t-days")
    append_by_day(spark.range(300).select("id", F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string")).alias("dt")), path, 0)
    day = read_day_partitioned(spark, path).where("dt = '2024-01-02'")
    assert day.count() == 100
    assert {f.split("dt=")[1].split("/")[0] for f in day.inputFiles()} >= {"2024-01-02"}
    scans = [x for x in day._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
    assert len(scans) == 1 and "2024-01-02" in scans[0].split("PartitionFilters: [")[1].split("]")[0]
    # the day known only when the query runs
    wanted = spark.createDataFrame([("2024-01-03", 1)], "dt string, flag int").where("flag = 1")
    joined = read_day_partitioned(spark, path).join(F.broadcast(wanted), "dt")
    assert joined.count() == 100 and "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString().lower()
