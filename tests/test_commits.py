"""Outputs and offsets of a batch published together: replays, crashes, a killed process."""

from __future__ import annotations

import os
import signal
import subprocess
import sys
from decimal import Decimal

from pyspark.sql import functions as F

from emporia.session import scratch_dir
from emporia.sources.topics import TopicStore
from emporia.streaming import jobs
from emporia.streaming.commits import BatchCommits, Output

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# a stream of sums over a file topic that may kill its own process between output and commit
KILLED = """
import os, signal, sys
from pyspark.sql import functions as F
from emporia.session import build_session
from emporia.sources.topics import TopicStore
from emporia.streaming import jobs
topic_root, out, ckpt, die_at = sys.argv[1:]
spark = build_session(master="local[2]", shuffle_partitions=2, app="emporia-kill")
stream = TopicStore(spark, root=topic_root).read_stream("W").select(F.from_json("value", "k string, v decimal(12,2)").alias("r")).select("r.*")
commits, outputs = jobs.ledger(spark, out, "k", "v", ckpt)
def between(batch_id):
    if batch_id == int(die_at):
        os.kill(os.getpid(), signal.SIGKILL)
jobs.run_available(stream.writeStream.foreachBatch(commits.writer(outputs, between)), "killed", spark, ckpt)
"""


def sums(commits):
    rows = commits.read("sums", jobs.LEDGER_SCHEMA).groupBy("trademark_name").agg(F.sum("amount").alias("s")).collect()
    return {r.trademark_name: r.s for r in rows}


def test_a_killed_stream_resumes_and_counts_every_batch_once(spark, tmp_path):
    topics = TopicStore(spark, root=str(tmp_path / "topics"))
    for i in range(4):
        values = [('{"k": "%s", "v": "%d.50"}' % (k, i),) for k in "ab"]
        topics.write_batch(spark.createDataFrame(values, "value string"), "W", files=1)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    run = lambda at: subprocess.run([sys.executable, "-c", KILLED, str(tmp_path / "topics"), out, ckpt, str(at)],
                                    env=os.environ | {"PYTHONPATH": ROOT}, cwd=ROOT, capture_output=True, timeout=240)
    assert run(2).returncode == -signal.SIGKILL
    commits = BatchCommits(spark, out, ckpt)
    # the third batch's sums are on disk, but not published
    assert os.path.isdir(f"{out}/sums/batch_id=2") and sorted(r.batch_id for r in commits.commits().collect()) == [0, 1]
    assert sums(commits) == {"a": Decimal("2.00"), "b": Decimal("2.00")}
    done = run(-1)
    assert done.returncode == 0, done.stderr.decode()[-2000:]
    assert len(os.listdir(f"{out}/sums/batch_id=2")) >= 2
    assert sums(commits) == {"a": Decimal("8.00"), "b": Decimal("8.00")}
    found = commits.commits().orderBy("batch_id").collect()
    assert [r.batch_id for r in found] == [0, 1, 2, 3] and all(r.offsets and r.outputs == ["sums"] for r in found)


def test_replayed_and_unpublished_batches(spark):
    commits, outputs = jobs.ledger(spark, scratch_dir(spark, "t-ledger"), "tm_name", "amt")
    assert commits.commits().count() == 0
    batch = spark.createDataFrame([("a", Decimal("1.10")), ("a", Decimal("2.20")), (None, Decimal("3.00"))], "tm_name string, amt decimal(12,2)")
    write = commits.writer(outputs)
    write(batch, 0)
    write(batch, 0)                          # published already: nothing is written again
    commits.write(batch, 1, outputs)         # written, never published
    assert sums(commits) == {"a": Decimal("3.30"), None: Decimal("3.00")}
    write(batch.limit(1), 1)
    assert sums(commits) == {"a": Decimal("4.40"), None: Decimal("3.00")}


def test_one_batch_feeds_two_outputs_from_one_computation(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(rows):
        for r in rows:
            seen.add(1)
            yield r

    batch = spark.range(50).rdd.mapPartitions(counted).toDF("id long").withColumn("dt", F.lit("2024-01-01"))
    outputs = {"table": Output(lambda b: b, partition_by=("dt",)), "topic": Output(lambda b: b.select(F.to_json(F.struct("id")).alias("value")), "text")}
    commits = BatchCommits(spark, scratch_dir(spark, "t-two"))
    commits.writer(outputs)(batch, 0)
    assert seen.value == 50
    assert commits.read("table", "id long, dt string").where("dt = '2024-01-01'").count() == 50
    assert commits.read("topic", "value string", "text").count() == 50
    # an empty batch is published too
    commits.writer(outputs)(batch.limit(0), 1)
    assert commits.read("table", "id long, dt string").count() == 50 and commits.published(1)
