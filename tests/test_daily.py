"""Daily documents: compaction, replays, bad documents; day tables that a replay leaves alone."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from emporia.operators.dau import DAU_COLUMNS
from emporia.session import scratch_dir
from emporia.sinks.daily import DailyDocs
from emporia.sinks.writers import append_by_day, archive_text_by_day, read_day_partitioned

DAY = 1704067200000


def _docs(spark, rows):
    full = [(mid, "u", "A", ch, "v", dt, "00", "00", ts) for mid, dt, ts, ch in rows]
    return spark.createDataFrame(full, "mid string, uid string, ar string, ch string, vc string, dt string, hr string, mi string, ts long")


def _got(sink):
    return sorted((r.dt, r.mid, r.ts, r.ch) for r in sink.read().collect())


def test_files_of_a_day_stay_bounded_and_replays_change_nothing(spark):
    sink = DailyDocs(spark, scratch_dir(spark, "t-daily"), compact_every=3)
    want = {}
    for n in range(12):
        rows = [("m", "2024-01-01", DAY + 100 - n, "c"), (f"d{n}", "2024-01-01", DAY + n, "c")]
        if n == 4:
            rows.append(("late", "2023-12-31", DAY - 5, "c"))
        sink.write(_docs(spark, rows), n)
        want.update({(dt, mid): (dt, mid, ts, ch) for mid, dt, ts, ch in rows})
        one = sink.raw().where("dt = '2024-01-01'").select("mid").inputFiles()
        day = [f for f in one if "dt=2024-01-01" in f]
        assert len([f for f in day if "/base/" in f]) <= 1
    assert _got(sink) == sorted(want.values())
    now = sink.manifest()
    assert (now.version, now.upto) == (4, 11) and now.days == {"2024-01-01": 4, "2023-12-31": 2}
    scans = sink._deltas(now.upto)
    assert scans.count() == 0 and "batch_id" in scans._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("]")[0]
    # batches that a compaction has taken in, and the last one, come again
    for n in (2, 11):
        sink.write(_docs(spark, [("m", "2024-01-01", DAY + 100 - n, "c"), (f"d{n}", "2024-01-01", DAY + n, "c")]), n)
    assert _got(sink) == sorted(want.values())


def test_a_compaction_without_manifest_is_not_seen_and_done_again(spark):
    sink = DailyDocs(spark, scratch_dir(spark, "t-daily"), compact_every=100)
    sink.write(_docs(spark, [("m", "2024-01-01", DAY, "c")]), 0)
    # what a writer that died before its manifest leaves
    _docs(spark, [("ghost", "2024-01-01", DAY, "c"), ("ghost", "2024-01-09", DAY, "c")]).write.partitionBy("dt").parquet(f"{sink.path}/base/version=1")
    assert _got(sink) == [("2024-01-01", "m", DAY, "c")]
    sink.compact(0)
    assert _got(sink) == [("2024-01-01", "m", DAY, "c")] and sink.manifest().days == {"2024-01-01": 1}


def test_ties_go_by_the_record_whatever_the_batch(spark):
    for order in ((0, 1), (1, 0)):
        sink = DailyDocs(spark, scratch_dir(spark, "t-daily"))
        for n, k in enumerate(order):
            sink.write(_docs(spark, [("m", "2024-01-01", DAY, ("b", "a")[k])]), n)
        assert _got(sink) == [("2024-01-01", "m", DAY, "a")]


@pytest.mark.parametrize("bad", [(None, "2024-01-01", DAY, "c"), ("m", None, DAY, "c"), ("m", "2024-01-01", None, "c"), ("m", "2024-1-1", DAY, "c"), ("m", "soon", DAY, "c")])
def test_a_bad_document_fails_its_batch_and_writes_nothing(spark, bad):
    sink = DailyDocs(spark, scratch_dir(spark, "t-daily"))
    with pytest.raises(ValueError, match="1 documents without"):
        sink.write(_docs(spark, [("good", "2024-01-01", DAY, "c"), bad]), 0)
    assert _got(sink) == []


def test_an_empty_batch_and_an_empty_store(spark):
    sink = DailyDocs(spark, scratch_dir(spark, "t-daily"), compact_every=1)
    assert sink.read().columns == DAU_COLUMNS and _got(sink) == []
    sink.write(_docs(spark, []), 0)
    sink.write(_docs(spark, [("m", "2024-01-01", DAY, "c")]), 1)
    assert _got(sink) == [("2024-01-01", "m", DAY, "c")]


def test_day_tables_hold_a_replayed_batch_once(spark):
    rows = spark.range(30).select(F.col("id").cast("string").alias("value"), F.concat(F.lit("2024-01-0"), F.col("id") % 3 + 1).alias("dt"))
    table, archive = scratch_dir(spark, "t-append"), scratch_dir(spark, "t-archive")
    for n in (0, 1, 1, 0):
        append_by_day(rows, table, n)
        archive_text_by_day(rows, archive, n)
    assert read_day_partitioned(spark, table).count() == read_day_partitioned(spark, archive, "text").count() == 60
    assert read_day_partitioned(spark, archive, "text").columns == ["value", "dt"]
