"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source has a budget in words.  Whole epochs of a source come first: each
of its documents is taken as often as the budget holds the whole source.  The
rest of the budget is filled with a weighted sample without replacement: a
document of quality weight w has the key ``-ln(u) / w`` (u from a hash of the
row, so reruns agree), and documents enter in key order until their sizes'
prefix sum reaches the budget.  The document on which the budget ends gives
only the words that are left, so a source meets its target to the word.

No source is sorted as a whole.  Keys fall into ``KEY_BUCKETS`` ordered
buckets; sums per (source, bucket) tell in which bucket a budget ends.
Buckets before it are taken, buckets after it are not, and only that bucket's
rows are put in order.

Cases: a null text has size 0; a null source is a source of its own, sorted
last; a null or missing weight is 1, one below ``LEAST_WEIGHT`` is raised to
it; equal keys are ordered by doc_id and size; repeated rows are rows of
their own; a source without words has target 0; an empty table gives an empty
result; further columns of the documents are kept out of the way and returned
by ``mix``, but for ones named ``_size``, ``_target`` or ``_taken`` (of an
earlier mix), which the new ones replace.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporia.llm.common import WORD, packed, staged

SOURCE_WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_EPOCHS = 2.0
KEY_BUCKETS = 1 << 14
LEAST_WEIGHT = 0.01
SEED = 20


def targets(sizes: list[tuple[str | None, int]], weights=SOURCE_WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS) -> dict[str | None, float]:
    """Words to take of each source: ``share`` of all words by weight, at most ``most`` times a source's size."""
    order = sorted(sizes, key=lambda x: (x[0] is None, (x[0] or "").encode()))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    cap = {s: most * n for s, n in order}
    left, open_, out = share * sum(n for _, n in order), [s for s, _ in order], {}
    while open_:
        total = sum(weight[s] for s in open_)
        part = {s: left * weight[s] / total for s in open_}
        above = [s for s in open_ if part[s] > cap[s]]
        if not above:
            return out | part
        for s in above:
            out[s] = cap[s]
        left -= sum(cap[s] for s in above)
        open_ = [s for s in open_ if s not in set(above)]
    return out


def n_words(text):
    """Words of a text without building them: each is one character of the reduced text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def taken_words(sized: DataFrame) -> DataFrame:
    """(doc_id, tie, source, size, weight) rows with source_size, target and taken.

    What reaches the driver is one row a source, not a document.
    """
    spark = sized.sparkSession
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("tie")), 11).cast("double") + 0.5) / float(1 << 53)
    weight = F.greatest(F.lit(LEAST_WEIGHT), F.coalesce(F.col("weight"), F.lit(1.0)))
    keyed = sized.withColumn("key", -F.log(u) / weight)
    keyed = keyed.withColumn("bucket", F.floor((1 - F.exp(-F.col("key"))) * KEY_BUCKETS))
    keyed = staged(keyed.drop("weight"), "mix-keys")

    per_bucket = staged(keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-buckets")
    totals = [(r.source, r.n) for r in per_bucket.groupBy("source").agg(F.sum("words").alias("n")).collect()]
    goal = targets(totals)
    epochs = {s: int(goal[s] // n) if n else 0 for s, n in totals}
    budget = {s: round(goal[s] - epochs[s] * n) for s, n in totals}

    # the bucket in which each source's budget ends; none if the budget holds the whole source
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    budgets = spark.createDataFrame([(s, budget[s]) for s, _ in totals], "b_source string, budget long")
    ends = (
        per_bucket.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
        .join(budgets, F.col("source").eqNullSafe(F.col("b_source")))
        .where((F.col("before") <= F.col("budget")) & (F.col("budget") < F.col("before") + F.col("words")))
    )
    end = {r.source: (r.bucket, r.before) for r in ends.select("source", "bucket", "before").collect()}
    plan = [(s, n, float(goal[s]), epochs[s], budget[s], *end.get(s, (KEY_BUCKETS + 1, 0))) for s, n in totals]
    plan = spark.createDataFrame(plan, "p_source string, source_size long, target double, epochs long, budget long, end_bucket long, before long")
    rows = keyed.join(plan, F.col("source").eqNullSafe(F.col("p_source")))

    taken = lambda part: (F.col("epochs") * F.col("size") + part).cast("long").alias("taken")
    cols = ["doc_id", "tie", "source", "size", "source_size", "target"]
    whole = F.when(F.col("bucket") < F.col("end_bucket"), F.col("size")).otherwise(0)
    out = rows.where(F.col("bucket") != F.col("end_bucket")).select(*cols, taken(whole))
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    last = rows.where(F.col("bucket") == F.col("end_bucket"))
    last = last.withColumn("room", F.col("budget") - F.col("before") - F.coalesce(F.sum("size").over(order), F.lit(0)))
    part = F.least(F.col("size"), F.greatest(F.lit(0), F.col("room")))
    return out.unionByName(last.select(*cols, taken(part)))


def _sized(docs: DataFrame, weights: DataFrame | None) -> DataFrame:
    rows = docs.select("doc_id", F.xxhash64("text").alias("tie"), "source", n_words(F.col("text")).alias("size"))
    if weights is None:
        return rows.withColumn("weight", F.lit(1.0))
    per_doc = weights.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg("weight").alias("weight"))
    return rows.join(per_doc, "doc_id", "left")


def label_weights(labels: DataFrame) -> DataFrame:
    """doc_id, weight: documents labelled good enter four times as readily as ones labelled bad."""
    return labels.select("doc_id", F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).otherwise(1.0).alias("weight"))


def mixing_plan(docs: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every document row."""
    return taken_words(_sized(docs, weights)).drop("tie")


def mix(docs: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """The documents that the mix takes, all their columns, with ``_size``, ``_target`` and ``_taken``.

    Rows alike in doc_id and text share what is taken of them evenly.
    """
    plan = taken_words(_sized(docs, weights)).groupBy("doc_id", "tie").agg(
        F.first("size").alias("_size"), F.max("target").alias("_target"), (F.expr("sum(taken) div count(*)")).alias("_taken")
    )
    rows = packed(docs, _id="doc_id").withColumn("_tie", F.xxhash64("_row.text"))
    kept = rows.join(plan.where(F.col("_taken") > 0), F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_tie") == F.col("tie")))
    own = [F.col("_row").getField(c).alias(c) for c in docs.columns if c.lower() not in ("_size", "_target", "_taken")]
    return kept.select(*own, "_size", "_target", "_taken")
