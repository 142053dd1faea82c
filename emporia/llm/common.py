"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emporia.session import checkpoint_root

WHITESPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 5
SIMILARITY_PCT = 75


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a table every executor can read, so a lost executor
    costs a re-read and never a re-run of what came before.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def packed(df: DataFrame, **needed: str) -> DataFrame:
    """``df`` with its whole row in ``_row`` and the ``needed`` columns under private names.

    Operators that add columns work on this form, so that a caller's columns
    can have any names; ``unpacked`` restores the caller's row.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *[F.col(f"`{c}`").alias(k) for k, c in needed.items()])


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("_row.*")


def words_of(text: Column) -> Column:
    """Words of a text in order; a null text has none.

    Texts whose only white space are spaces and line feeds are split without a regular expression.
    """
    plain = F.array_remove(F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " "), "")
    other = F.contains(text, F.lit("\t")) | F.contains(text, F.lit("\x0b")) | F.contains(text, F.lit("\x0c")) | F.contains(text, F.lit("\r"))
    none = F.array().cast("array<string>")
    return F.when(text.isNull(), none).when(other, F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).otherwise(plain)


def ranked(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``_pos``, a row's place (from 0) in its group by ``order``, and ``_size``, the group's rows.

    Rows are range partitioned, so a group of any size runs on over as many
    partitions as it fills.  A partition numbers its rows as they are written;
    what goes from one partition to the next is one count a group.  ``group``
    has no nulls; rows equal in ``order`` should be equal altogether.
    """
    rows = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    rows = staged(rows.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), name)
    runs = rows.groupBy("_part", group).agg(F.min("_at").alias("_first"), F.count("_at").alias("_n"))
    whole = Window.partitionBy(group)
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(F.col("_part").alias("_p"), F.col(group).alias("_g"), (before - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("_size"))
    placed = rows.join(runs, (F.col("_part") == F.col("_p")) & (F.col(group) == F.col("_g")))
    return placed.select(*df.columns, (F.col("_at") + F.col("_shift")).alias("_pos"), "_size")


#: A key that holds more than 1/HOT_SHARE of all rows is hot; there are at most HOT_SHARE such keys.
HOT_SHARE = 1000


def with_keyed(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row for every ``key`` of ``rows``; neither has nulls there.

    The rows of hot keys, at most ``HOT_SHARE`` of them by definition, are
    joined with a broadcast, the others by a shuffle, so that no task gets
    more than its share of one key.  Give both staged: they are read twice.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.count()
    hot = counts.where(F.col("_n") * HOT_SHARE > total).select(key)
    hot_rows = rows.join(F.broadcast(table.join(F.broadcast(hot), key, "left_semi")), key)
    return hot_rows.unionByName(rows.join(F.broadcast(hot), key, "left_anti").join(table, key))
