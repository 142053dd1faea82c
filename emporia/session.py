"""Spark session defaults and the shared scratch area.

Everything that is written between stages (topic files, stream sinks,
checkpoints, ledgers) lives below ``spark.checkpoint.dir``: on a cluster that
is the shared folder the cluster names, so a lost executor never takes data
with it.  We only choose a folder ourselves when the session has none (tests,
local runs).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every job relies on.  AQE re-plans joins from runtime statistics
# (broadcast when a side turns out small, split skewed partitions), and the
# forced skew-join lets AQE split a hot key even when that costs one more
# exchange downstream.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # counting the state's rows would look up every key before it is written or removed
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # one state store a partition for both sides of a stream join, not four
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # a restart needs the last batches' state, not that of the last hundred
    "spark.sql.streaming.minBatchesToRetain": "4",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "emporia") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options on an existing session (driver-made sessions)."""
    for k, v in SESSION_DEFAULTS.items():
        if k == "spark.sql.streaming.stateStore.providerClass":
            # only settable before the first stateful query of the session
            try:
                spark.conf.set(k, v)
            except Exception:  # pragma: no cover - already fixed for this session
                pass
            continue
        spark.conf.set(k, v)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts, stream state and staged tables.

    Read from ``spark.checkpoint.dir``; only when the session has none (a test
    or a laptop) do we pick a fresh local folder and record it in the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="emporia-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    try:  # classic sessions: also the RDD checkpoint folder used by checkpoint()
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
    except Exception:  # pragma: no cover - sessions without a SparkContext handle
        pass
    return root


@contextmanager
def set_for(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session option that holds inside the block only."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (caches are per application)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # pragma: no cover
        return spark.conf.get("spark.app.id", str(id(spark)))


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/emporia/{name}-{uuid.uuid4().hex[:12]}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nobody reads any more; kept where the session has no SparkContext to reach its store."""
    try:
        sc = spark.sparkContext
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    except Exception:  # pragma: no cover - sessions without a SparkContext handle
        return
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the checkpoint root and read back: its plan runs
    once however often the result is used, and a lost executor re-reads it."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
