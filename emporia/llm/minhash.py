"""MinHash near-duplicates: a signature-coordinate inverted join.

A document's set are its distinct 5-word shingles.  Documents with equal sets
form a class, joined through the set's digest and never paired.  Classes get
a MinHash signature of ``COORDINATES`` values; pairs that agree on at least
``MATCHES`` of them are confirmed on the full sets.

Posting lists hold the classes under each (coordinate, value).  A value of a
single class is in no pair, so a class has m useful lists, and one that agrees
with another on ``MATCHES`` lists meets it in its ``m - MATCHES + 1`` rarest
ones too (all lists have one global order, by length): only that prefix is
posted, and the long lists of passages that many documents share are skipped,
though they count when the collisions of two signatures are.  Linked sets
share at least 75 % of each one's shingles and 3/7 of both sizes' sum; a
class of which more than 25 % occur in no other posted class is in no link and
leaves the lists, which are then made anew without it, and two classes are
paired only if the smaller count of shingles found elsewhere allows a link.
So documents that a long passage or a common origin makes alike, but not alike
enough, are hardly ever paired.

Only the linked components are wanted, so a list needn't be turned into all
of its pairs.  Its members are first paired with one center, the member whose
lists are the longest, then with the first member so found outside the
center's component.  The members of lists that still span several components
are joined exactly, by what sets them apart from a center: near copies have
nearly all of their shingles in common, so any two of them share rare ones,
but few lack or add the same ones.  Two sets differ in as many shingles as
their differences from any third set do; so of two linked sets both are
linked with the center, or their differences share an element, not too far
down in either's order, rarest first.  Nobody within the center's component is
paired with another of it, and who is outside first meets, by each element,
only the one in it that is nearest to the center.  Members that don't resemble the center get another
one, for a few rounds; those that resemble none are joined by their rarest
shingles (a quarter of the larger's, a seventh of the smaller's).  Then no
link is left but what the signature loses (a pair at similarity 0.75 fails to
agree on 12 of 32 coordinates in about 2 of 1,000,000 cases).

Cases: a null or empty text has no shingles and is linked with nothing; a
text under five words is one shingle; a null doc_id takes no part and is
kept; rows with one doc_id are one document, linked through the text of any of
them; equal texts share a class; an empty table gives an empty result; other
columns are returned as they were.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import SHINGLE_WORDS, SIMILARITY_PCT, packed, staged

COORDINATES = 32
MATCHES = 12
CENTER_ROUNDS = 2
PIVOT_ROUNDS = 3
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def shingle_hashes(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles.

    ``bytes.lower`` and ``bytes.split`` are the wanted rules: A-Z only, and
    white space of ASCII only.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(SHINGLE_WORDS, len(w))
    out = np.full(len(w) - size + 1, size, np.uint64)
    for j in range(size):
        out = (out ^ w[j : len(w) - size + 1 + j]) * _MULT
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _coordinate_seeds() -> np.ndarray:
    seeds = np.arange(1, COORDINATES + 1, dtype=np.uint64) * _MULT
    return (seeds ^ (seeds >> np.uint64(31))) * _MIX


def signature(hashes: np.ndarray) -> np.ndarray:
    """The COORDINATES smallest values of a set under different hash functions, shortened to 32 bits."""
    out = np.empty(COORDINATES, np.uint64)
    for i, seed in enumerate(_coordinate_seeds()):
        x = (hashes ^ seed) * _MIX
        out[i] = ((x ^ (x >> np.uint64(32))) * _MULT).min()
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _id_type(docs: DataFrame):
    return docs.schema["doc_id"].dataType.simpleString()


def _set_id(hashes: np.ndarray) -> bytes | None:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_id (digest of the set), sig of every document."""

    def sketch(batches):
        for batch in batches:
            sizes, ids, sigs = [], [], []
            for text in batch.column("text").to_pylist():
                h = shingle_hashes(text)
                sizes.append(len(h))
                ids.append(_set_id(h))
                sigs.append(signature(h) if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(sigs, pa.list_(pa.int32()))],
                names=["doc_id", "n_shingles", "set_id", "sig"],
            )

    return docs.select("doc_id", "text").mapInArrow(sketch, f"doc_id {_id_type(docs)}, n_shingles long, set_id binary, sig array<int>")


def prefixes(classes: DataFrame) -> DataFrame:
    """node, weight, key: the prefix of every class's posting lists, rarest first.

    ``weight`` is high for a class whose lists are long, one that resembles many others.
    """
    all_lists = classes.select("node", F.posexplode("sig").alias("coordinate", "value"))
    all_lists = all_lists.select("node", F.xxhash64("coordinate", "value").alias("key"))
    lengths = all_lists.groupBy("key").agg(F.count("node").alias("length")).where(F.col("length") > 1)
    useful = all_lists.join(lengths, "key").groupBy("node").agg(F.sort_array(F.collect_set(F.struct("length", "key"))).alias("lists"))
    weight = F.aggregate("lists", F.lit(0.0), lambda s, x: s + F.log(x["length"]))
    prefix = useful.where(F.size("lists") >= MATCHES).select("node", weight.alias("weight"), F.explode(F.slice("lists", 1, F.size("lists") - (MATCHES - 1))).alias("list"))
    return prefix.select("node", "weight", "list.key")


def postings(classes: DataFrame) -> DataFrame:
    """The prefixes with the class's columns (node, sig, ...)."""
    return prefixes(classes).join(classes, "node")


def _collisions(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)


def full_sets(docs: DataFrame, holders: DataFrame) -> DataFrame:
    """node, hashes of the sets of the documents in ``holders`` (holder, repeated: it has several rows).

    A set comes once, or twice where it is also that of a repeated document.
    """

    def sets(batches):
        for batch in batches:
            found = [shingle_hashes(t) for t in batch.column("text").to_pylist()]
            nodes = [_set_id(h) for h in found]
            arrays = [pa.array(nodes, pa.binary()), pa.array([h.view(np.int64) for h in found], pa.list_(pa.int64())), batch.column("repeated")]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "hashes", "repeated"])

    wanted = docs.select("doc_id", "text").join(holders, F.col("doc_id") == F.col("holder")).select("text", "repeated")
    found = staged(wanted.mapInArrow(sets, "node binary, hashes array<bigint>, repeated boolean").where(F.col("node").isNotNull()), "sets")
    once = found.where(F.col("repeated")).dropDuplicates(["node"])
    return found.where(~F.col("repeated")).unionByName(once).drop("repeated")


def linkable(sets: DataFrame) -> DataFrame:
    """node and shared (its shingles that occur in other sets too) where those are enough for a link.

    A shingle found once names its only node, so own shingles are counted without a join.
    The node goes as two numbers there: the smallest of numbers needs no sorting.
    """
    named = sets.select("node", "hashes", F.xxhash64("node").alias("hi"), F.xxhash64(F.lit(1), "node").alias("lo"))
    each = named.select("hi", "lo", F.explode("hashes").alias("shingle"))
    alone = each.groupBy("shingle").agg(F.count("hi").alias("n"), F.min("hi").alias("hi"), F.min("lo").alias("lo")).where(F.col("n") == 1)
    own = alone.groupBy("hi", "lo").agg(F.count("n").alias("own"))
    sizes = named.select("node", "hi", "lo", F.size("hashes").alias("size"))
    found = sizes.join(own, ["hi", "lo"], "left").withColumn("shared", F.col("size") - F.coalesce("own", F.lit(0)))
    return found.where(100 * F.col("shared") >= SIMILARITY_PCT * F.col("size")).select("node", "shared").distinct()


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    small, large = F.least(F.size("ha"), F.size("hb")), F.greatest(F.size("ha"), F.size("hb"))
    joined = pairs.join(left, "a").join(right, "b").where(100 * small >= SIMILARITY_PCT * large)
    return joined.where(100 * both >= SIMILARITY_PCT * (F.size("ha") + F.size("hb") - both)).select("a", "b").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, label (the smallest node it is connected with) of every node in ``edges`` (a, b).

    Smallest labels of neighbours, then labels of labels, until none changes;
    every step is written, so a lost executor repeats one step at most.
    """
    both = staged(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), name)
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), name)
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("n")).agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("node") == F.col("n")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        heads = labels.select(F.col("node").alias("h"), F.col("label").alias("far"))
        step = staged(step.join(heads, F.col("mid") == F.col("h"), "left").select("node", "old", F.least("mid", "far").alias("label")), name)
        labels = step.select("node", "label")
        if step.where(F.col("old") != F.col("label")).isEmpty():
            return labels


def _relabelled(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Labels after further edges: components of the labels that the edges connect."""
    if labels is None:
        return components(edges)
    a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    named = edges.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    heads = components(named.where(F.col("a") != F.col("b")).distinct()).select(F.col("node").alias("h"), F.col("label").alias("far"))
    moved = labels.join(heads, F.col("label") == F.col("h"), "left").select("node", F.coalesce("far", "label").alias("label"))
    new = heads.select(F.col("h").alias("node"), F.col("far").alias("label")).join(labels, "node", "left_anti")
    return staged(moved.union(new), "labels")


def rare_pairs(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of different labels that may be linked, by prefixes of their rarest shingles.

    With all shingles of (node, label, hashes) in one order, rarest first, a
    shingle at places i and j leaves at most ``min(n - i, m - j)`` shingles in
    common with it and after it; a link needs 3/7 of both sizes' sum.
    """
    each = sets.select("node", "label", F.explode("hashes").alias("shingle"))
    sigs = sets.groupBy("node").agg(F.first("sig").alias("sig"))
    counts = each.groupBy("shingle").agg(F.count("node").alias("found"))
    order = each.join(counts, "shingle").groupBy("node", "label").agg(F.sort_array(F.collect_set(F.struct("found", "shingle"))).alias("order"))
    reach = F.floor(F.size("order") * (100 - SIMILARITY_PCT) / 100).cast("int") + 1
    prefix = order.select("node", "label", F.size("order").alias("n"), F.posexplode(F.slice("order", F.lit(1), reach)).alias("place", "s"))
    prefix = prefix.where(F.col("s.found") > 1).select("node", "label", "n", "place", "s.shingle").join(sigs, "node")
    prefix = staged(prefix, "rare-shingles")
    large = prefix.select("shingle", F.col("sig").alias("sx"), F.col("node").alias("x"), F.col("label").alias("lx"), F.col("n").alias("nx"), F.col("place").alias("px"))
    both = large.join(prefix, "shingle").where(
        (F.col("lx") != F.col("label")) & ((F.col("nx") > F.col("n")) | ((F.col("nx") == F.col("n")) & (F.col("x") > F.col("node"))))
        & ((100 + SIMILARITY_PCT) * F.least(F.col("n"), F.col("nx") - F.col("px"), F.col("n") - F.col("place")) >= SIMILARITY_PCT * (F.col("nx") + F.col("n")))
        & (_collisions(F.col("sx"), F.col("sig")) >= MATCHES)
    )
    return both.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()


def centers(members: DataFrame) -> DataFrame:
    """key and its center (a, na, shared_a, sa, la, wa): the member of the greatest weight."""
    center = F.struct(*[F.col(c).alias(to) for c, to in (("node", "a"), ("n", "na"), ("shared", "shared_a"), ("sig", "sa"), ("label", "la"), ("weight", "wa"))])
    return members.groupBy("key").agg(F.min_by(center, F.struct(-F.col("weight"), F.col("node"))).alias("c")).select("key", "c.*")


def _still_open(members: DataFrame) -> DataFrame:
    """The members of lists that span several components."""
    open_ = members.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where(F.col("lo") != F.col("hi")).select("key")
    return staged(members.join(open_, "key", "left_semi"), "open-lists")


def common_centers(members: DataFrame) -> DataFrame:
    """key and a center that several lists have: the heaviest one that the list's own center resembles and shares a list with."""
    columns = ["a", "na", "sa", "la", "wa"]
    own = staged(centers(members).select("key", *columns), "centers")
    met = members.join(own.select(F.col("a").alias("node")).distinct(), "node", "left_semi").select("key", "node", "weight", "sig").join(own, "key")
    heavier = met.where((F.col("wa") > F.col("weight")) & (_collisions(F.col("sa"), F.col("sig")) >= MATCHES))
    heavier = heavier.groupBy(F.col("node").alias("h")).agg(F.max_by(F.struct(*columns), F.struct("wa", "a")).alias("far"))
    return own.join(heavier, F.col("a") == F.col("h"), "left").select("key", *[F.coalesce(F.col(f"far.{c}"), F.col(c)).alias(c) for c in columns])


def difference_pairs(met: DataFrame, sets: DataFrame, nearest: bool) -> DataFrame:
    """Pairs (a, b) of different labels that may be linked, one of them near a center that both have met.

    ``met`` has a row (a, na, la, node, n, label, near) for a node and a center ``a``
    of label ``la``; ``sets`` has each node once.  Sets of n and m shingles whose
    differences from the center have d and e elements, o of them in common, differ
    in d + e - 2o, which for a link is at most 1/7 of n + m.  If d + e is no more
    than that, each one is linked with the center, and only those links are returned.
    With ``nearest``, a node is paired by each element with the one node of the
    center's component that has it and differs least from the center.
    """
    center = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    apart = met.join(sets.select("node", "hashes"), "node").join(center, "a")
    apart = apart.withColumn("apart", F.concat(F.array_except("hashes", "ha"), F.array_except("ha", "hashes"))).drop("hashes", "ha")
    apart = staged(apart.withColumn("d", F.size("apart")), "apart")
    star = apart.where((F.col("label") != F.col("la")) & ((100 + SIMILARITY_PCT) * F.col("d") <= (100 - SIMILARITY_PCT) * (F.col("n") + F.col("na"))))
    star = star.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))

    each = apart.select("a", "la", "node", "label", "n", "near", "d", F.explode("apart").alias("shingle"))
    counts = each.groupBy("a", "shingle").agg(F.count("node").alias("found"))
    order = each.join(counts, ["a", "shingle"]).groupBy("a", "la", "node", "label", "n", "near", "d").agg(F.sort_array(F.collect_list(F.struct("found", "shingle"))).alias("order"))
    reach = F.floor(F.col("n") * (100 - SIMILARITY_PCT) / SIMILARITY_PCT).cast("int") + 1
    prefix = order.select("a", "la", "node", "label", "n", "near", "d", F.posexplode(F.slice("order", F.lit(1), reach)).alias("place", "s"))
    prefix = staged(prefix.where(F.col("s.found") > 1).select("a", "la", "node", "label", "n", "near", "d", "place", "s.shingle"), "differences")
    other = prefix.where(F.col("label") != F.col("la"))
    if nearest:
        columns = ["node", "label", "n", "near", "d", "place"]
        found = prefix.where(F.col("label") == F.col("la")).groupBy("a", "la", "shingle")
        prefix = found.agg(F.min_by(F.struct(*columns), F.struct("d", "node")).alias("least")).select("a", "la", "shingle", "least.*")
    other = other.select("a", "shingle", *[F.col(c).alias(f"x_{c}") for c in ("node", "label", "n", "near", "d", "place")])
    n, d, left = F.col("x_n") + F.col("n"), F.col("x_d") + F.col("d"), F.least(F.col("x_d") - F.col("x_place"), F.col("d") - F.col("place"))
    missing = (100 + SIMILARITY_PCT) * d - (100 - SIMILARITY_PCT) * n
    both = other.join(prefix, ["a", "shingle"]).where(
        (F.col("x_label") != F.col("label")) & (F.col("x_near") | F.col("near")) & ((F.col("label") == F.col("la")) | (F.col("x_node") > F.col("node")))
        & (100 * F.least("x_n", "n") >= SIMILARITY_PCT * F.greatest("x_n", "n")) & (missing > 0) & (2 * (100 + SIMILARITY_PCT) * left >= missing)
    )
    return both.select(F.least("x_node", "node").alias("a"), F.greatest("x_node", "node").alias("b")).unionByName(star).distinct()


def pairs_left(here: DataFrame, sets: DataFrame, nearest: bool) -> DataFrame:
    """Pairs (a, b) that connect all components of the open lists ``here`` that a link connects; with ``nearest``, a few of them."""
    sets = staged(sets.join(here.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]), "open-sets")
    found = []
    for _ in range(PIVOT_ROUNDS):
        # used for the pairs and for what is left of the lists
        chosen = staged(common_centers(here), "common-centers")
        with_center = here.join(chosen, "key").withColumn("near", _collisions(F.col("sa"), F.col("sig")) >= MATCHES)
        met = with_center.select("a", "na", "la", "node", "n", "label", "near").distinct()
        found.append(difference_pairs(met, sets, nearest))
        if nearest:
            break
        here = _still_open(with_center.where(~F.col("near")).select(here.columns))
        if here.isEmpty():
            break
    else:
        found.append(rare_pairs(sets.join(here.groupBy("node", "label").agg(F.first("sig").alias("sig")), "node")))
    return reduce(DataFrame.unionByName, found).distinct()


def linked_nodes(members: DataFrame, sets: DataFrame) -> DataFrame:
    """node, label over all confirmed links of the posting lists' members."""
    labels = None
    for step in range(CENTER_ROUNDS + 2):
        here = members.withColumn("label", F.col("node")) if labels is None else members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        if step:
            here = _still_open(here)
            if here.isEmpty():
                break
            # components only grow: a list within one stays so
            members = here.drop("label")
        if step < CENTER_ROUNDS:
            # after the first round, the center comes from outside the first one's component
            rest = here if not step else here.join(centers(here).select("key", "la"), "key").where(F.col("label") != F.col("la"))
            pairs = here.join(centers(rest), "key")
            alike = (100 + SIMILARITY_PCT) * F.least("n", "na", "shared_a", "shared") >= SIMILARITY_PCT * (F.col("na") + F.col("n"))
            pairs = pairs.where((F.col("la") != F.col("label")) & alike & (_collisions(F.col("sa"), F.col("sig")) >= MATCHES))
            pairs = pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
        else:
            pairs = pairs_left(here, sets, nearest=step == CENTER_ROUNDS)
        edges = staged(confirmed(pairs, sets), "edges")
        if labels is None or not edges.isEmpty():
            labels = _relabelled(labels, edges)
    return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, set_id, n_shingles, component_id, kept for every document row.

    A class goes by its set's digest (``node``).  Classes with texts of one
    document are connected after the links are known.
    """
    rows = staged(sketches(docs), "sketches")
    named = rows.where(F.col("set_id").isNotNull() & F.col("doc_id").isNotNull())
    classes = named.groupBy(F.col("set_id").alias("node")).agg(F.min("doc_id").alias("holder"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
    classes = staged(classes, "classes")
    classes_of = classes.select("node", "n", "sig")
    repeated = staged(named.groupBy("doc_id").agg(F.count("set_id").alias("_n"), F.min("set_id").alias("first"), F.max("set_id").alias("last")).where(F.col("_n") > 1), "repeated")

    posted = prefixes(classes_of).select("node").distinct()
    holders = classes.join(posted, "node", "left_semi").select("holder").distinct()
    again = repeated.select(F.col("doc_id").alias("holder"), F.lit(True).alias("repeated"))
    sets = full_sets(docs, holders.join(again, "holder", "left").select("holder", F.coalesce("repeated", F.lit(False)).alias("repeated")))
    near = staged(linkable(sets), "linkable")
    members = staged(postings(classes_of.join(near, "node")), "postings")
    labels = linked_nodes(members, sets)

    several = repeated.where(F.col("first") != F.col("last")).select("doc_id", F.col("first").alias("a"))
    same = staged(named.join(several, "doc_id").select("a", F.col("set_id").alias("b")).where(F.col("a") != F.col("b")).distinct(), "same-id")
    if not same.isEmpty():
        labels = _relabelled(labels, same)

    label = classes.select("node", "holder").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = label.groupBy("label").agg(F.min("holder").alias("component"))
    of_set = staged(label.join(smallest, "label").select(F.col("node").alias("c_set"), "component"), "component-of-set")
    with_component = named.join(of_set, F.col("set_id") == F.col("c_set"))
    columns = ["doc_id", "set_id", "n_shingles"]
    out = with_component.select(*columns, F.col("component").alias("component_id"))
    # rows without a set: alone, or with the other rows of their document
    bare = rows.where(F.col("set_id").isNull() & F.col("doc_id").isNotNull()).select(*columns)
    others = named.join(bare.select("doc_id").distinct(), "doc_id", "left_semi").join(of_set, F.col("set_id") == F.col("c_set"))
    others = others.groupBy(F.col("doc_id").alias("o_id")).agg(F.min("component").alias("component"))
    bare = bare.join(others, F.col("doc_id") == F.col("o_id"), "left").select(*columns, F.coalesce("component", "doc_id").alias("component_id"))
    nameless = rows.where(F.col("doc_id").isNull()).select(*columns, F.col("doc_id").alias("component_id"))
    out = out.unionByName(bare).unionByName(nameless)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that are their component's smallest doc_id, with the columns they came with."""
    gone = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return packed(docs, _id="doc_id").join(gone, F.col("_id") == F.col("_gone"), "left_anti").select("_row.*")
