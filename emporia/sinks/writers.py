"""Sinks (operators 56, 59, 61): day tables, log archive, dimension versions.

A write replaces what it owns (a batch's folder, a version) and nothing else, so
a batch that is run again is there once.  A day table or an archive is a folder
a batch, ``batch_id=N/dt=D``.  The JDBC branch of ``append_by_day`` appends and
has no such guard.  Daily documents are in ``sinks.daily``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.operators.dims import upsert_latest


def read_day_partitioned(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A day table read back, without its batch numbers and with ``dt`` as
    ``yyyy-MM-dd`` text (partition discovery would infer a date)."""
    df = spark.read.format(fmt).load(path)
    return df.withColumn("dt", F.col("dt").cast("string")).drop("batch_id")


def _dynamic_overwrite(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet") -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).format(fmt).save(path))


def append_by_day(df: DataFrame, path: str, batch_id: int, jdbc: dict | None = None) -> None:
    """Append a batch's rows to a day-partitioned table (operator 59).

    Files: the batch's own folder, partitioned by ``dt`` after a ``rebalance`` on ``dt``: one shuffle
    by day, after which AQE splits a day that holds a large share of the rows
    over several tasks and merges small days into one task (no sampling pass,
    so the input plan runs once).  JDBC (``jdbc={"url", "table", ...}``): the reference's
    options - batch size 100, no isolation - and as many writers as ``writers``
    says (the input's partitions without it)."""
    if jdbc:
        rows = df.repartition(jdbc["writers"]) if "writers" in jdbc else df
        (rows.write.mode("append").format("jdbc")
         .option("url", jdbc["url"]).option("dbtable", jdbc["table"])
         .option("batchsize", jdbc.get("batchsize", 100)).option("isolationLevel", "NONE")
         .options(**jdbc.get("options", {})).save())
        return
    df.hint("rebalance", "dt").write.mode("overwrite").partitionBy("dt").parquet(f"{path}/batch_id={batch_id}")


class DimensionVersions:
    """A dimension table kept as numbered versions (operator 56).  ``upsert``
    writes version N+1 = latest row per key over (version N ∪ changes); a
    re-run of the same upsert rewrites the same version."""

    def __init__(self, spark: SparkSession, path: str, key: str = "id"):
        self.spark = spark
        self.path = path
        self.key = key

    def write_version(self, df: DataFrame, version: int) -> None:
        _dynamic_overwrite(df.withColumn("version", F.lit(version)), self.path, ["version"])

    def read_version(self, version: int) -> DataFrame:
        return self.spark.read.parquet(self.path).where(F.col("version") == version).drop("version")

    def upsert(self, changes: DataFrame, order_col: str, base_version: int) -> int:
        current = self.read_version(base_version)
        merged = upsert_latest(current, changes.select(*current.columns, order_col), self.key, order_col)
        self.write_version(merged, base_version + 1)
        return base_version + 1


def archive_text_by_day(lines: DataFrame, path: str, batch_id: int, dt_col: str = "dt") -> None:
    """A batch's raw lines to text files, one folder per day (operator 61)."""
    day = lines.select("value", F.col(dt_col).alias("dt")).hint("rebalance", "dt")
    day.write.mode("overwrite").partitionBy("dt").text(f"{path}/batch_id={batch_id}")
