"""Dimension tables under change streams, full outer and dealt stream joins, JDBC options."""

from __future__ import annotations

import glob
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.session import scratch_dir
from emporia.sinks.dimensions import DimTable
from emporia.sources import relational
from emporia.sources.topics import TopicStore
from emporia.streaming import jobs

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, name string, xid long")


def test_upserts_rewrite_touched_buckets_only_and_replay_nothing(spark):
    dim = DimTable(spark, scratch_dir(spark, "t-dim"), SCHEMA, n_buckets=4)
    assert dim.read().count() == 0
    dim.upsert(changes(spark, *[(i, f"n{i}", 1) for i in range(40)]), 0)
    before = dim.folders()
    assert len(before) == 4
    # several changes of a key in one batch, ties of the offset, a null key
    touched = dim.upsert(changes(spark, (7, "b", 3), (7, "a", 2), (7, "c", 3), (None, "x", 9)), 1)
    after = dim.folders()
    assert len(touched) == 1 and {b: p for b, p in after.items() if b not in touched} == {b: p for b, p in before.items() if b not in touched}
    written = {os.path.basename(p) for p in glob.glob(f"{dim.root}/rows/batch_id=1/*/bucket=*")}
    assert written == {f"bucket={touched[0]}"}
    got = {r.id: r.name for r in dim.read().collect()}
    assert got == {i: f"n{i}" for i in range(40)} | {7: "c"}
    # a change that arrives late doesn't undo a newer one; a replayed batch changes nothing
    dim.upsert(changes(spark, (7, "late", 1), (100, "new", 1)), 2)
    assert dim.upsert(changes(spark, (7, "again", 99)), 2) == []
    got = {r.id: r.name for r in dim.read().collect()}
    assert got[7] == "c" and got[100] == "new" and len(got) == 41
    dim.upsert(changes(spark, (1, "x", 1)).limit(0), 3)
    assert dim.read().count() == 41


def test_an_unpublished_upsert_is_invisible(spark, monkeypatch):
    dim = DimTable(spark, scratch_dir(spark, "t-dim-crash"), SCHEMA, n_buckets=2)
    dim.upsert(changes(spark, (1, "a", 1)), 0)
    good = spark.createDataFrame

    def no_manifest(*a, **k):
        raise RuntimeError("crash before the manifest")

    monkeypatch.setattr(type(spark), "createDataFrame", no_manifest)
    bad = spark.range(1).select(F.col("id") + 1, F.lit("b").alias("name"), F.lit(2).cast("long").alias("xid")).toDF("id", "name", "xid")
    with pytest.raises(RuntimeError):
        dim.upsert(bad, 1)
    monkeypatch.undo()
    assert good is not None and [r.name for r in dim.read().collect()] == ["a"]
    dim.upsert(bad, 1)
    assert {r.id: r.name for r in dim.read().collect()} == {1: "b"}


def test_a_lookup_reads_only_the_buckets_of_its_keys(spark):
    dim = DimTable(spark, scratch_dir(spark, "t-dim-look"), SCHEMA, n_buckets=8)
    dim.upsert(changes(spark, *[(i, f"n{i}", 1) for i in range(80)]), 0)
    found = dim.lookup(spark.createDataFrame([(5,), (5,), (None,), (999,)], "k long"), "k")
    assert [(r.id, r.name) for r in found.collect()] == [(5, "n5")]
    buckets = {p.split("bucket=")[1].split("/")[0] for p in found.inputFiles() if "bucket=" in p}
    assert 1 <= len(buckets) <= 2


def _messages(spark, topics, topic, values):
    topics.write_batch(spark.createDataFrame([(json.dumps(v),) for v in values], "value string"), topic, files=1)


def order(oid, t):
    return {"id": oid, "final_total_amount": "1.00", "create_time": t, "create_date": t[:10]}


def line(did, oid, t):
    return {"id": did, "order_id": oid, "sku_num": 1, "create_time": t}


def _joined(spark, topics, name, **how):
    out = scratch_dir(spark, name)
    j = jobs.order_detail_join(topics.read_stream("O"), topics.read_stream("D"), 10, **how).select("order_detail_id", "order_id", "dt")
    w = j.writeStream.format("parquet").option("path", out).outputMode("append")
    ckpt = jobs.run_available(w, name, spark)
    return out, ckpt


def test_full_outer_stream_emits_unmatched_rows_once_the_watermark_has_passed(spark):
    topics = TopicStore(spark)
    _messages(spark, topics, "O", [order(1, "2024-01-01 10:00:00"), order(2, "2024-01-01 10:00:00")])
    _messages(spark, topics, "D", [line(11, 1, "2024-01-01 10:00:05"), line(12, 1, "2024-01-01 10:00:20"), line(91, 9, "2024-01-01 10:00:00")])
    _messages(spark, topics, "O", [order(5, "2024-02-01 10:00:00")])
    _messages(spark, topics, "D", [line(51, 5, "2024-02-01 10:00:30")])
    out, _ = _joined(spark, topics, "t-outer", how="full_outer")
    got = sorted((tuple(r) for r in spark.read.parquet(out).collect()), key=repr)
    # order 5 and line 51 are still open: too far apart to meet, too new to be given up
    assert got == sorted([(11, 1, "2024-01-01"), (12, 1, None), (None, 2, "2024-01-01"), (91, 9, None)], key=repr)
    with pytest.raises(ValueError):
        jobs.order_detail_join(topics.read_stream("O"), topics.read_stream("D"), 10, how="full_outer", salts=4)


def test_a_hot_orders_lines_are_dealt_over_tasks_and_meet_it_once(spark):
    topics = TopicStore(spark)
    _messages(spark, topics, "O", [order(1, "2024-01-01 10:00:00"), order(2, "2024-01-01 10:00:00")])
    _messages(spark, topics, "D", [line(i, 1, "2024-01-01 10:00:01") for i in range(400)] + [line(1000, 2, "2024-01-01 10:00:01")])
    out, _ = _joined(spark, topics, "t-dealt", salts=8)
    got = spark.read.parquet(out)
    assert got.count() == 401 and got.distinct().count() == 401
    # the file sink writes a file a task that has rows
    assert got.where("order_id = 1").select(F.input_file_name()).distinct().count() > 1


def test_jdbc_reads_need_their_bounds():
    got = relational.jdbc_options("jdbc:x", "t", "id", 0, 1000, 8, fetchsize=5, user="u")
    assert got["numPartitions"] == "8" and got["lowerBound"] == "0" and got["upperBound"] == "1000" and got["fetchsize"] == "5" and got["partitionColumn"] == "id"
    for bad in ({"lower": None, "upper": 1, "parts": 1}, {"lower": 2, "upper": 1, "parts": 1}, {"lower": 0, "upper": 1, "parts": 0}):
        with pytest.raises(ValueError):
            relational.jdbc_options("jdbc:x", "t", "id", **bad)
    with pytest.raises(ValueError):
        relational.read_parts(None, "jdbc:x", "t", [])
