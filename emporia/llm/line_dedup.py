"""Line deduplication over the corpus, as keep bitmaps.

A line's key is the line without white space at its ends, A-Z in lower case.
Keys of at least ``MIN_CHARS`` characters found in at least ``MIN_DOCS``
documents keep their lines only in the largest doc_id that holds them.

Lines travel as 128-bit hashes, never as text.  The hashes are range
partitioned with the document (largest first) and position as secondary sort and
stored as that stream.  Within each partition a running comparison tells of
every line whether it stands in the key's first document there, and how many
documents follow.  A hot key's rows run on over several partitions; only the
keys at the partitions' edges can, at most two a partition, and what is known of
them over the whole stream is broadcast.  No join is keyed by a line's hash, and no
task gets more of a key than its range partition holds.  The marked lines come
back as one run-length coded bitmap a document.

Cases: a null or empty text is one empty line; a document without an id takes
no part and keeps its lines; rows with the same doc_id are the same document; very long texts are one row of hashes a line; equal lines within
the owner all stay; an empty table gives an empty result; other columns are
returned as they were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.llm.common import WHITESPACE, let, packed, staged

MIN_CHARS = 20
MIN_DOCS = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def ascii_lower(text: Column) -> Column:
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, tie, pos, h1, h2 of every line whose key is long enough; tie tells texts under one doc_id apart."""
    lines = docs.where(F.col("doc_id").isNotNull() & (F.char_length("text") >= min_chars)).select(
        "doc_id", F.xxhash64("text").alias("tie"), F.posexplode(lines_of(ascii_lower(F.col("text")))).alias("pos", "line")
    )
    keys = lines.withColumn("key", F.trim("line", F.lit(WHITESPACE))).where(F.char_length("key") >= min_chars)
    return keys.select("doc_id", "tie", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(MIN_CHARS), F.col("key")).alias("h2"))


def sorted_stream(lines: DataFrame) -> DataFrame:
    """The lines by key, largest doc_id first, then position, stored with the range partition (part) they stand in.

    A (key, doc_id) pair stands in one partition; a key may run on over several.
    """
    stream = lines.repartitionByRange("h1", "h2", F.desc("doc_id")).sortWithinPartitions("h1", "h2", F.desc("doc_id"), "pos")
    return staged(stream.select("*", F.spark_partition_id().alias("part")), "line-stream")


def edge_keys(stream: DataFrame) -> DataFrame:
    """h1, h2, edge_owner, edge_docs over the whole stream of the first and last key of each partition: two rows a partition at most."""
    ends = stream.groupBy("part").agg(F.min(F.struct("h1", "h2")).alias("a"), F.max(F.struct("h1", "h2")).alias("b"))
    keys = ends.select(F.explode(F.array("a", "b")).alias("key")).select("key.*").distinct()
    pairs = stream.join(F.broadcast(keys), ["h1", "h2"], "left_semi").select("h1", "h2", "doc_id").distinct()
    return pairs.groupBy("h1", "h2").agg(F.max("doc_id").alias("edge_owner"), F.count("doc_id").alias("edge_docs"))


def repeated_lines(stream: DataFrame, min_docs: int) -> DataFrame:
    """doc_id, tie, pos of the lines to be dropped: of keys in ``min_docs`` documents or more, outside the first document."""
    stretch = Window.partitionBy("part", "h1", "h2")
    running = stretch.orderBy(F.desc("doc_id"))
    rows = stream.withColumn("nth", F.dense_rank().over(running)).withColumn("n_docs", F.max("nth").over(stretch))
    rows = rows.join(F.broadcast(edge_keys(stream)), ["h1", "h2"], "left")
    first = F.when(F.col("edge_owner").isNull(), F.col("nth") == 1).otherwise(F.col("doc_id") == F.col("edge_owner"))
    return rows.where(~first & (F.coalesce("edge_docs", "n_docs") >= min_docs)).select("doc_id", "tie", "pos")


def _runs(dropped: Column) -> Column:
    """Sorted positions as runs (start, length)."""
    starts = F.filter(dropped, lambda p, k: F.coalesce(F.get(dropped, k - 1) != p - 1, F.lit(True)))
    ends = F.filter(dropped, lambda p, k: F.coalesce(F.get(dropped, k + 1) != p + 1, F.lit(True)))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b - a + 1).alias("length")))


def drop_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, tie, runs: the lines to be dropped of every document that loses some, as runs (start, length)."""
    marked = repeated_lines(sorted_stream(line_hashes(docs, min_chars)), min_docs)
    each = marked.groupBy("doc_id", "tie").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    return each.select("doc_id", "tie", let(F.col("dropped"), _runs).alias("runs"))


def kept_text(text: Column, runs: Column) -> Column:
    """The lines outside the runs, joined by a line feed."""

    def join(lines: Column) -> Column:
        end = lambda i: F.coalesce(F.get(runs, i - 1).start + F.get(runs, i - 1).length, F.lit(0))
        stay = F.transform(F.sequence(F.lit(0), F.size(runs)), lambda i: F.slice(lines, end(i) + 1, F.coalesce(F.get(runs, i).start, F.size(lines)) - end(i)))
        return F.array_join(F.flatten(stay), "\n")

    return F.when(runs.isNull(), text).otherwise(let(lines_of(text), join))


def with_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Each document's row in ``_row``, its _text and the _runs to be dropped (null: none)."""
    marks = drop_bitmaps(docs, min_chars, min_docs).select(F.col("doc_id").alias("_m_id"), F.col("tie").alias("_m_tie"), F.col("runs").alias("_runs"))
    rows = packed(docs, _id="doc_id", _text="text").withColumn("_tie", F.xxhash64("_text"))
    return rows.join(marks, (F.col("_id") == F.col("_m_id")) & (F.col("_tie") == F.col("_m_tie")), "left").select("_row", "_id", "_text", "_runs")


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """The documents with their kept lines; n_chars follows the text where it changed."""
    rows = with_bitmaps(docs).withColumn("_kept", kept_text(F.col("_text"), F.col("_runs")))
    new = {"text": F.col("_kept"), "n_chars": F.when(F.col("_runs").isNull(), F.col("_row.n_chars")).otherwise(F.char_length("_kept").cast("long"))}
    return rows.select(*[new[c].alias(c) if c in new else F.col(f"_row.`{c}`") for c in docs.columns])
