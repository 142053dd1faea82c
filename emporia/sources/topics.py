"""Topics: where the reference reads and writes Kafka topics.

``TopicStore`` reads and writes a topic either through Spark's Kafka
connector (``format="kafka"``, key/value/topic columns) or, where no broker
exists, as a folder of compressed JSON-line files below the shared checkpoint
root.  A file topic is read as a stream with ``readStream.text``; files are
taken in the order they were written, a published slice at a time.

``publish_in_slices`` writes a topic as ``n`` consecutive commits cut by
event-time quantiles, so a stream over it sees ``n`` ordered micro-batches of
like size, as a topic filling up over time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.session import SHUFFLE_CLEANUP, discard, scratch_dir, set_for

# Codec of file topics: JSON lines repeat their field names, and neighbours share an order's fields.
COMPRESSION = "gzip"


@dataclass
class TopicStore:
    spark: SparkSession
    root: str | None = None              # folder of file topics
    format: str = "files"                # "files" or "kafka"
    kafka_servers: str | None = None
    slice_files: dict[str, int] = field(default_factory=dict)   # files of one published slice, by topic
    next_offset: dict[str, int] = field(default_factory=dict)   # of file topics, as far as known

    def __post_init__(self):
        if self.root is None:
            self.root = scratch_dir(self.spark, "topics")

    def path(self, topic: str) -> str:
        return f"{self.root}/{topic}"

    # ---- read ------------------------------------------------------------
    def end_offset(self, topic: str) -> int:
        """The offset that the next write to a file topic gets: its number of writes so far."""
        if topic not in self.next_offset:
            try:
                last = self.spark.read.schema("value string, offset long").text(self.path(topic)).agg(F.max("offset")).first()[0]
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                last = None
            self.next_offset[topic] = 0 if last is None else last + 1
        return self.next_offset[topic]

    def _start(self, topic: str, starting_offsets: str | int) -> int:
        end = self.end_offset(topic)
        start = {"earliest": 0, "latest": end}.get(starting_offsets, starting_offsets)
        if isinstance(start, bool) or not isinstance(start, int) or not 0 <= start <= end:
            raise ValueError(f"{topic} has the offsets 0 to {end}, not {starting_offsets!r}")
        return start

    def read_stream(self, topic: str, slices_per_trigger: int = 1, starting_offsets: str | int = "earliest") -> DataFrame:
        """A topic as a streaming frame with a ``value`` text column (operator
        1).  A file topic is taken ``slices_per_trigger`` published slices (of
        one file, where nothing was published in slices) at a time.

        ``starting_offsets``: ``earliest``, ``latest`` (what is written from
        now on) or, for a Kafka topic, the connector's JSON.  A file topic's
        offset is the number of a write to it, a partition of its folder, so
        that earlier writes are not read; one it doesn't have raises."""
        if self.format == "kafka":
            return (
                self.spark.readStream.format("kafka")
                .option("kafka.bootstrap.servers", self.kafka_servers)
                .option("subscribe", topic)
                .option("startingOffsets", starting_offsets)
                .load()
                .select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
            )
        rows = (
            self.spark.readStream.schema("value string, offset long")
            .option("maxFilesPerTrigger", slices_per_trigger * self.slice_files.get(topic, 1))
            .text(self.path(topic))
        )
        start = self._start(topic, starting_offsets)
        return (rows.where(F.col("offset") >= start) if start else rows).select("value")

    def read_batch(self, topic: str) -> DataFrame:
        if self.format == "kafka":
            return (
                self.spark.read.format("kafka")
                .option("kafka.bootstrap.servers", self.kafka_servers)
                .option("subscribe", topic)
                .load()
                .select(F.col("value").cast("string").alias("value"))
            )
        return self.spark.read.schema("value string, offset long").text(self.path(topic)).select("value")

    # ---- write -----------------------------------------------------------
    def write_batch(self, df: DataFrame, topic: str | None = None, files: int | None = None) -> None:
        """Append ``value`` (and ``key``) rows to a topic (operator 55).  With
        ``topic=None`` the rows carry a ``topic`` column and one write fans
        out to every topic."""
        if self.format == "kafka":
            out = df if topic is None else df.withColumn("topic", F.lit(topic))
            cols = [c for c in ("key", "value", "topic") if c in out.columns]
            (out.select(*cols).write.format("kafka")
             .option("kafka.bootstrap.servers", self.kafka_servers).save())
            return
        out = df if files is None else df.repartition(files)
        if topic is None:
            out.select("topic", "value").write.mode("append").partitionBy("topic").text(self.root, compression=COMPRESSION)
        else:
            offset = self.end_offset(topic)
            out.select("value").write.mode("append").text(f"{self.path(topic)}/offset={offset}", compression=COMPRESSION)
            self.next_offset[topic] = offset + 1

    def publish_in_slices(self, df: DataFrame, topic: str, event_time: Column, slices: int, rows_per_file: int = 50_000,
                          rows_per_slice: int = 1_000_000, cuts: list[float] | None = None, copies: int = 1, value: Column | None = None) -> list[float]:
        """Write ``df.value`` to ``topic`` as up to ``slices`` consecutive
        commits in event-time order, each holding about the same number of
        rows, and each written in parallel into the same number of files.
        There are more than ``slices`` where these would hold over
        ``rows_per_slice`` rows, so a trigger's size doesn't grow with the
        topic.  ``cuts`` (another topic's, as returned) may fix the times.
        Every slice is written ``copies`` times, one write after the other.
        With ``value``, an expression over the columns of ``df``, the columns
        are staged and each slice makes its texts of them.

        The rows are staged once, so the source query runs once however many
        slices there are; cuts and counts come from the staged event times, and
        the stage is removed when the last slice is written.
        Each staged file is in order of time, so writing a slice reads the
        pages that hold it and not the whole stage.
        ``read_stream`` then takes one slice per trigger by default, so the
        rows of a micro-batch never straddle a commit.  Rows without an event
        time go to the first slice.  The shuffle files of a write are removed as it ends, not
        when the driver happens to collect garbage: a topic's texts are shuffled a slice at a time."""
        with set_for(self.spark, SHUFFLE_CLEANUP, "true"):
            return self._publish(df, topic, event_time, slices, rows_per_file, rows_per_slice, cuts, copies, value)

    def _write_slice(self, rows: DataFrame, topic: str, files: int, value: Column | None) -> None:
        """One commit of a topic in ``files`` files.  Where the stage has as many, a task
        takes whole stage files: nothing is shuffled, and rows that lie together there
        (an order's lines) stay together, which compresses best."""
        many = rows.rdd.getNumPartitions() >= files
        dealt = rows.coalesce(files) if many else rows.repartition(files).sortWithinPartitions("_t")
        self.write_batch(dealt.select((F.col("value") if value is None else value).alias("value")), topic)
        if self.format == "kafka":
            return
        # a task without rows left no file, and a trigger takes a fixed number of them
        written = len(self.spark.read.text(f"{self.path(topic)}/offset={self.next_offset[topic] - 1}").inputFiles())
        for _ in range(files - written):
            nothing = self.spark.createDataFrame([], "value string")
            nothing.write.mode("append").text(f"{self.path(topic)}/offset={self.next_offset[topic] - 1}", compression=COMPRESSION)

    def _publish(self, df, topic, event_time, slices, rows_per_file, rows_per_slice, cuts, copies, value):
        stage = scratch_dir(self.spark, f"stage-{topic}")
        columns = ["value"] if value is None else df.columns
        timed = df.select(*columns, F.coalesce(event_time.cast("double"), F.lit(float("-inf"))).alias("_t"))
        timed.sortWithinPartitions("_t").write.parquet(stage, compression="zstd")
        staged = self.spark.read.parquet(stage)
        if cuts is None:
            slices = max(slices, -(-staged.count() // rows_per_slice))
            cuts = staged.agg(F.percentile_approx("_t", [i / slices for i in range(1, slices)]).alias("c")).first()["c"]
        cuts = sorted(set(cuts or []))
        # number of cuts at or below the row's time: one group per slice
        no = F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda c: F.col("_t") > c))
        counts = sorted((r["n"], r["count"]) for r in staged.groupBy(no.alias("n")).count().collect())
        largest = max((c for _, c in counts), default=0)
        files = -(-largest // rows_per_file) or 1
        # ties can leave a slice nearly empty: it joins its successor, so each
        # has rows for every one of its files
        groups, cur, rows = [], [], 0
        for n, c in counts:
            cur, rows = [*cur, n], rows + c
            if rows * 8 >= largest:
                groups.append(cur)
                cur, rows = [], 0
        if cur:
            groups = [*groups[:-1], groups[-1] + cur]
        for g in groups:
            # neighbouring slices: a range of times, which the scan compares with its pages' statistics
            rows = staged if g[0] == 0 else staged.where(F.col("_t") > cuts[g[0] - 1])
            rows = rows if g[-1] == len(cuts) else rows.where(F.col("_t") <= cuts[g[-1]])
            for _ in range(copies):
                self._write_slice(rows, topic, files, value)
        for _ in range(copies if not groups else 0):
            self._write_slice(staged, topic, 1, value)
        # the topic holds the rows now
        discard(self.spark, stage)
        self.slice_files[topic] = files
        return cuts
