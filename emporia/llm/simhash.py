"""SimHash near-duplicates by anchor-point covering.

A document's fingerprint has 64 bits: bit k is set if it is set in over half of
the hashes (XXH64, seed 42) of the document's 4-word shingles, repeats
included.  Fingerprints that differ in at most ``RADIUS`` = 4 bits are linked.

Of two such fingerprints' ``BLOCKS`` (22, 21 and 21 bits) one differs in at
most one bit.  Each block has a covering code, the direct sum of the Hamming
code of length 15, which covers 15 bits with radius 1, and of all words of the
remaining bits: every block value lies within ``COVERING`` = 1 of a code word,
its home anchor, and so does any value one bit away within ``COVERING`` + 1.
A fingerprint goes once to its home and is replicated to every anchor within
``COVERING`` + 1, about 15 a block; at each anchor the homes are compared with
the replicas, each pair at the home of its smaller one.  No link is lost.

There are 2^18 + 2 * 2^17 anchors, however many fingerprints.  Where one has
more than ``CELL`` homes or replicas these are dealt over cells, every cell of
homes meeting every cell of replicas in a group of its own; a table of such
anchors is bounded by the number of anchors.  Within a large group candidates
are found by equal values of one of five smaller blocks (of 4 differing bits
one of five blocks has none).  A group's links leave as a forest of its
connected fingerprints, never as pairs.  Documents of equal fingerprint are
never compared.

Cases: a null or empty text, or one without words, has the fingerprint zero,
linked like any other; under four words the whole sequence is one shingle; very
long texts are read in slices; rows with one doc_id are hashed one by one, and
repeated rows share a fingerprint; a row without a doc_id takes part in links
but names no component: its component is the smallest doc_id reachable, null
where there is none; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import staged, with_keyed
from emporia.llm.minhash import components

SHINGLE = 4
SEED = 42
RADIUS = 4
BLOCKS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
HAMMING = 15
COVERING = 1
CELL = 100_000
SLICE_BYTES = 1 << 22
PAIRS_AT_ONCE = 1 << 21
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _slices(text: bytes):
    """A text's words, a bounded slice at a time, the last words of a slice again before the next."""
    at, carry = 0, []
    while True:
        end = at + SLICE_BYTES
        space = _SPACE.search(text, end) if end < len(text) else None
        words = carry + text[at : space.start() if space else len(text)].lower().split()
        yield words, space is None
        if space is None:
            return
        at, carry = space.end(), words[-(SHINGLE - 1) :]


def fingerprint(text: bytes | None) -> int:
    """The 64 bits of a text as an unsigned number."""
    ones, n = np.zeros(64, np.int64), 0
    for words, last in _slices(text or b""):
        if len(words) < SHINGLE and not (last and not n):
            continue
        if not words:
            break
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        k = min(SHINGLE, len(words)) - 1
        starts = [0, *ends[: len(words) - 1 - k].tolist()]
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, (ends[k:] - 1).tolist())]
        for i in range(0, len(hashes), 4096):
            part = np.array(hashes[i : i + 4096], np.uint64)
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0]) if n else 0


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of every document."""

    def hashed(batches):
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py()) for t in batch.column("text")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(hashed, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def _syndromes(values: np.ndarray) -> np.ndarray:
    """Syndromes of the low HAMMING bits; bit i has the column i + 1 of the parity check."""
    out = np.zeros(len(values), np.int64)
    for i in range(HAMMING):
        out ^= np.where(values >> np.uint64(i) & np.uint64(1), i + 1, 0)
    return out


def offsets(bits: int) -> list[np.ndarray]:
    """By syndrome of a block value: what its anchors within COVERING + 1 differ in from it, home first."""
    single = [1 << i for i in range(bits)]
    near = np.array([0, *single, *[a | b for i, a in enumerate(single) for b in single[i + 1 :]]], np.uint64)
    of = _syndromes(near)
    # the code word next to a value is at distance 0 or, by flipping one of the Hamming bits, 1
    return [near[of == s] for s in range(HAMMING + 1)]


def postings(classes: DataFrame) -> DataFrame:
    """anchor, rep (0: at its home, 1: replica), fp of every fingerprint."""

    def post(batches):
        tables = [offsets(bits) for _, bits in BLOCKS]
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for k, (first, bits) in enumerate(BLOCKS):
                value = fp >> np.uint64(first) & np.uint64((1 << bits) - 1)
                syndrome = _syndromes(value)
                for s, off in enumerate(tables[k]):
                    here = np.flatnonzero(syndrome == s)
                    if len(here):
                        anchors = (value[here, None] ^ off[None, :] | np.uint64(k << 32)).astype(np.int64)
                        reps = np.tile(np.ones(len(off), np.int8), (len(here), 1))
                        anchors, reps = np.hstack([anchors[:, :1], anchors]), np.hstack([0 * reps[:, :1], reps])
                        fps = np.repeat(fp[here].view(np.int64), len(off) + 1)
                        yield pa.RecordBatch.from_arrays([pa.array(anchors.ravel()), pa.array(reps.ravel()), pa.array(fps)], names=["anchor", "rep", "fp"])

    return classes.select("fp").mapInArrow(post, "anchor long, rep tinyint, fp long")


def cells(posted: DataFrame, most: int = CELL) -> DataFrame:
    """Postings with the cell of their group; those of crowded anchors are dealt over a grid of cells."""
    crowd = posted.groupBy("anchor").agg(F.sum(1 - F.col("rep")).alias("h"), F.sum("rep").alias("r")).where((F.col("h") > most) | (F.col("r") > most))
    grid = crowd.select("anchor", F.ceil(F.col("h") / most).cast("long").alias("nh"), F.greatest(F.lit(1), F.ceil(F.col("r") / most)).cast("long").alias("nr"))
    # at most one row an anchor, and the number of anchors is fixed
    both = posted.join(F.broadcast(grid), "anchor", "left").select("anchor", "rep", "fp", F.coalesce("nh", F.lit(1)).alias("nh"), F.coalesce("nr", F.lit(1)).alias("nr"))
    home, mine = F.col("rep") == 0, F.xxhash64("fp")
    other = F.explode(F.sequence(F.lit(0), F.when(home, F.col("nr")).otherwise(F.greatest(F.lit(1), F.col("nh"))) - 1))
    both = both.withColumn("other", other).withColumn("mine", F.pmod(mine, F.when(home, F.greatest(F.lit(1), F.col("nh"))).otherwise(F.col("nr"))))
    h, r = F.when(home, F.col("mine")).otherwise(F.col("other")), F.when(home, F.col("other")).otherwise(F.col("mine"))
    return both.select("anchor", (h * F.lit(1 << 31) + r).alias("cell"), "rep", "fp")


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x < y) & (np.bitwise_count(x ^ y) <= RADIUS)


def _spans(first: np.ndarray, count: np.ndarray, at_once: int):
    """(i, first[i] .. first[i] + count[i]) over all i, as flat index arrays of bounded length."""
    ends = np.cumsum(count)
    at = 0
    while at < len(count):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + at_once, "right")))
        n = count[at:to]
        i = np.repeat(np.arange(at, to), n)
        yield i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[at:to], n)
        at = to


def _group_links(homes: np.ndarray, reps: np.ndarray, at_once: int):
    """Links between the homes and the replicas of one large group."""
    for k in range(5):
        shift, low = np.uint64(13 * k), np.uint64((1 << 13) - 1)
        order = np.argsort(reps >> shift & low, kind="stable")
        keys, want = (reps >> shift & low)[order], homes >> shift & low
        first = np.searchsorted(keys, want, "left")
        for i, j in _spans(first, np.searchsorted(keys, want, "right") - first, at_once):
            x, y = homes[i], reps[order[j]]
            hit = _near(x, y)
            yield x[hit], y[hit]


def _forest(x: np.ndarray, y: np.ndarray):
    """One link (smallest connected value, value) for every value but the smallest of each connected set."""
    values, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    a, b = at[: len(x)], at[len(x) :]
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label, new.copy())
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = np.flatnonzero(label != np.arange(len(values)))
    return values[label[far]], values[far]


def _links(batches, at_once: int):
    """A sorted stream of (anchor, cell, rep, fp) -> links (a, b), a forest for every stretch of the stream."""
    names, held = ("anchor", "cell", "rep", "fp"), None
    found: list[tuple[np.ndarray, np.ndarray]] = []
    n_found = 0

    def groups(part):
        nonlocal n_found
        fp = part["fp"].view(np.uint64)
        start = np.flatnonzero(np.r_[True, (part["anchor"][1:] != part["anchor"][:-1]) | (part["cell"][1:] != part["cell"][:-1])])
        end = np.r_[start[1:], len(fp)]
        home = np.add.reduceat(part["rep"] == 0, start, dtype=np.int64)
        reps = end - start - home
        for g in np.flatnonzero(home * reps > at_once):
            m = start[g] + home[g]
            yield from _group_links(fp[start[g] : m], fp[m : end[g]], at_once)
        small = np.flatnonzero((home * reps <= at_once) & (home > 0) & (reps > 0))
        # every home of a small group against the group's replicas
        owner = np.repeat(small, home[small])
        i_home = np.arange(len(owner)) - np.repeat(np.cumsum(home[small]) - home[small], home[small]) + start[owner]
        for i, j in _spans(start[owner] + home[owner], reps[owner], at_once):
            x, y = fp[i_home[i]], fp[j]
            hit = _near(x, y)
            yield x[hit], y[hit]

    def flush():
        a, b = _forest(*(np.concatenate(s) for s in zip(*found)))
        found[:] = [(a, b)]

    for batch in batches:
        new = {n: batch.column(n).to_numpy() for n in names}
        part = new if held is None else {n: np.concatenate([held[n], new[n]]) for n in names}
        if not len(part["fp"]):
            continue
        last = int(np.flatnonzero((part["anchor"] == part["anchor"][-1]) & (part["cell"] == part["cell"][-1]))[0])
        held = {n: v[last:] for n, v in part.items()}
        if last:
            for x, y in groups({n: v[:last] for n, v in part.items()}):
                found.append((x, y))
                n_found += len(x)
                if n_found > at_once:
                    flush()
                    n_found = len(found[0][0])
                    if n_found > at_once // 2:
                        yield from _edges(found.pop())
                        n_found = 0
    if held is not None:
        found.extend(groups(held))
    if found:
        flush()
        yield from _edges(found.pop())


def _edges(pair):
    a, b = pair
    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def links(classes: DataFrame, most: int = CELL, at_once: int = PAIRS_AT_ONCE) -> DataFrame:
    """a, b: links that connect all distinct fingerprints (column fp) within RADIUS of one another.

    ``most``: homes or replicas of a group; ``at_once``: pairs compared at a time.
    """
    dealt = cells(staged(postings(classes), "anchor-postings"), most)
    dealt = dealt.repartition("anchor", "cell").sortWithinPartitions("anchor", "cell", "rep", "fp")
    return dealt.mapInArrow(lambda batches: _links(batches, at_once), "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp, fingerprint (hex), component_id for every document row."""
    rows = staged(fingerprints(docs), "fingerprints")
    classes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    labels = components(staged(links(classes), "fingerprint-links"), "fingerprint-labels").select(F.col("node").alias("fp"), "label")
    named = staged(classes.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp")), "fingerprint-named")
    heads = named.groupBy("label").agg(F.min("least").alias("component_id"))
    table = staged(named.join(heads, "label").select("fp", "component_id"), "fingerprint-components")
    out = with_keyed(rows, table, "fp")
    return out.select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
