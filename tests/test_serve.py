"""Paging by counts: places far down, bunched keys, several groups."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from emporia.operators.serve import page_per_group


@pytest.mark.parametrize("first,last", [(1, 10), (5_000, 5_020), (99_991, 100_000), (99_995, 100_010), (100_001, 100_005)])
def test_pages_far_down_equal_a_full_ranking(spark, first, last):
    # ids bunched at both ends; a small group beside the large one
    ids = spark.range(100_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.col("id") * 1_000_003).alias("k"), F.lit("big").alias("g"))
    df = ids.unionByName(spark.range(7).select((F.col("id") * 11).alias("k"), F.lit("small").alias("g")))
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("k"))).where(F.col("rn").between(first, last))
    got = page_per_group(df, "g", "k", first, last)
    assert sorted((r.g, r.k, r.rn) for r in got.collect()) == sorted((r.g, r.k, r.rn) for r in want.collect())
    assert {(r.g, r.total) for r in got.collect()} <= {("big", 100_000), ("small", 7)}


def test_only_rows_of_the_located_ranges_are_ranked(spark):
    df = spark.range(200_000).select(F.col("id").alias("k"), F.lit("g").alias("g"))
    page = page_per_group(df, "g", "k", 150_001, 150_010)
    assert [r.k for r in page.orderBy("k").collect()] == list(range(150_000, 150_010))
    ranked = []

    def walk(node):
        if node.nodeName() == "Window" and "row_number" in node.simpleString(1000):
            ranked.append(node)
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))

    walk(page._jdf.queryExecution().optimizedPlan())
    assert len(ranked) == 1
    below = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, ranked[0].children().apply(0))
    assert below.count() < 200


def test_empty_and_single(spark):
    df = spark.createDataFrame([(5, "a")], "k long, g string")
    assert [tuple(r) for r in page_per_group(df, "g", "k", 1, 3).select("g", "k", "rn", "total").collect()] == [("a", 5, 1, 1)]
    assert page_per_group(df.limit(0), "g", "k", 1, 3).count() == 0
