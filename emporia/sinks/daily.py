"""Daily documents (operators 57, 58): one index a day, one document a device.

A batch writes what it has as ``delta/batch_id=N/dt=D``; every
``compact_every`` batches the days they touched are written anew, one document
a device, as ``base/version=V/dt=D``.  ``manifest/version=V`` is written last
and names the batches it has taken in and the version of each day, so a reader
sees either the state before a compaction or the one after it, and reads per
day one base and fewer than ``2 * compact_every`` batches, however many there
have been.  Nothing is renamed or deleted: what a later version replaced may be
removed by the store's own rules once no reader is older.

A replayed batch replaces its own rows; one that a compaction has already taken
in is written again but not read again.  A compaction that dies before its
manifest leaves a version that nobody reads and the next one overwrites.
A document without device, time or a proper day fails its whole batch, before
anything is written.

A device's document is its earliest of the day (``dau.first_visit``), so merging
in any order, and once more, gives the same.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.operators import dau as dau_ops

COMPACT_EVERY = 16
MANIFEST_SCHEMA = "version long, upto long, days map<string, long>"
DOC_SCHEMA = "mid string, uid string, ar string, ch string, vc string, hr string, mi string, ts long"


@dataclass
class Manifest:
    """The last compaction: its number, the batches up to which it has taken all in, and each day's version."""

    version: int = 0
    upto: int = -1
    days: dict[str, int] = field(default_factory=dict)


def check_documents(docs: DataFrame) -> None:
    """Raise if a document has no device, no time, or a day that isn't ``yyyy-MM-dd``."""
    # the date of a text that is none is null, and of an unpadded one another text
    day = F.date_format(F.try_to_date("dt", "yyyy-MM-dd"), "yyyy-MM-dd")
    good = F.col("mid").isNotNull() & F.col("ts").isNotNull() & F.coalesce(day == F.col("dt"), F.lit(False))
    bad = docs.where(~good).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("dt", "mid", "ts")).alias("first")).first()
    if bad.n:
        raise ValueError(f"{bad.n} documents without device, time or day, for example {bad.first!r}")


class DailyDocs:
    """The daily documents below ``path``; ``write`` fits ``foreachBatch``."""

    def __init__(self, spark: SparkSession, path: str, compact_every: int = COMPACT_EVERY):
        self.spark, self.path, self.compact_every = spark, path.rstrip("/"), compact_every

    def manifest(self) -> Manifest:
        """The manifest with the greatest version (one number a day reaches the driver)."""
        try:
            last = self.spark.read.schema(MANIFEST_SCHEMA).json(f"{self.path}/manifest").orderBy(F.desc("upto")).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return Manifest()
        return Manifest() if last is None else Manifest(last.version, last.upto, last.days or {})

    def write(self, docs: DataFrame, batch_id: int) -> None:
        docs = docs.select(*dau_ops.DAU_COLUMNS).persist()
        try:
            check_documents(docs)
            # one folder a batch, replaced as a whole when the batch is replayed
            docs.hint("rebalance", "dt").write.mode("overwrite").partitionBy("dt").parquet(f"{self.path}/delta/batch_id={batch_id}")
        finally:
            docs.unpersist()
        if batch_id - self.manifest().upto >= self.compact_every:
            self.compact(batch_id)

    def compact(self, upto: int) -> None:
        """Take all batches up to ``upto`` into the base; only the days they touch are written."""
        old = self.manifest()
        fresh = self._deltas(old.upto).where(F.col("batch_id") <= upto)
        touched = [r.dt for r in fresh.select("dt").distinct().collect()]   # days, not documents
        version = old.version + 1
        if touched:
            merged = dau_ops.first_visit(fresh.drop("batch_id").unionByName(self._base({d: v for d, v in old.days.items() if d in set(touched)})))
            merged.hint("rebalance", "dt").write.mode("overwrite").partitionBy("dt").parquet(f"{self.path}/base/version={version}")
        row = (version, upto, old.days | dict.fromkeys(touched, version))
        self.spark.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{self.path}/manifest/version={version}")

    def _deltas(self, after: int) -> DataFrame:
        schema = f"{DOC_SCHEMA}, dt string, batch_id long"
        try:
            rows = self.spark.read.schema(schema).parquet(f"{self.path}/delta")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], schema)
        return rows.where(F.col("batch_id") > after)

    def _base(self, days: dict[str, int]) -> DataFrame:
        schema = f"{DOC_SCHEMA}, dt string"
        if not days:
            return self.spark.createDataFrame([], schema)
        parts = [f"{self.path}/base/version={v}/dt={d}" for d, v in sorted(days.items())]
        return self.spark.read.schema(f"{schema}, version long").option("basePath", f"{self.path}/base").parquet(*parts).drop("version")

    def raw(self) -> DataFrame:
        """The documents as stored: the base of each day and the batches since, so a device may have several a day."""
        now = self.manifest()
        return self._deltas(now.upto).drop("batch_id").unionByName(self._base(now.days))

    def read(self) -> DataFrame:
        """One document per (dt, mid)."""
        return dau_ops.first_visit(self.raw())
