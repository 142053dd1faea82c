"""Benchmark decontamination: SimHash over item-sized windows, then exact similarity.

Each benchmark item has a 64-bit SimHash of its weighted 5-word shingles, and
one of its plain shingles where that differs.
Documents are read in windows of the items' own lengths; a window's
fingerprint is looked up in the multi-index of the items of that length: both
fingerprints are cut into ``BLOCKS`` blocks, and two that differ in at most
``RADIUS`` bits differ in at most ``RADIUS // BLOCKS`` bits of one block.  Each
block lists the fingerprints under their value there; those listed under a
value that near in any block are all within the radius, and some more, which a
count of all their bits puts aside.  Candidates
are verified by Jaccard similarity of the shingles' multisets, weighted or
plain, whichever is larger.  A shingle weighs 1 / (number of items that hold
it), so that wording shared by many items counts less; a foreign shingle
weighs 1, so an edit costs the more the more an item's wording is shared, and
the plain similarity keeps near copies of such items.

A window without any shingle of the benchmark has similarity 0 to every item,
so fingerprints are made only for windows around such shingles.  Windows of
64 bits at similarity 0.75 differ in 11 bits on average (deviation 3): the
radius of 23 loses about 6 in 100,000 of those by the binomial estimate (one
of 40,000 simulated; 19 lost 136), and fewer of nearer ones.

Items are broadcast in blocks of at most ``BLOCK_CHARS`` characters (one item
may be longer), about 20,000 items of 200 characters; the documents are read
once a block, so once for any benchmark up to that size.  An item takes some
bytes of index and its shingles, whatever the radius.  Holders are
counted over the whole benchmark first, and the counts of all shingles held
twice or more (16 bytes each) go with every block, so that the blocks' limit
doesn't change the result.  Nothing that grows with the documents leaves the
executors.

Cases: null or empty texts match nothing; items of under five words are one
shingle and match where the words stand; a document shorter than an item is
one window; very long texts are read whole, their
windows fingerprinted at most 4,096 at a time; repeated rows
match alike; rows under one doc_id, or without one, are told apart by their
texts; benchmark rows without an item_id are items, found under a null item_id;
ties between windows go to the first; empty tables give an empty result; other
columns are returned as they were.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from emporia.llm.common import SHINGLE_WORDS, SIMILARITY_PCT, packed

BITS = 64
BLOCKS = 4
RADIUS = 23
BLOCK_CHARS = 4 << 20
WEIGHT_ONE = 1 << 32  # the weight 1 in votes
_BLOCK_BITS = BITS // BLOCKS

MATCH = "item_id {}, similarity double, start long, n_words long"


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case."""
    return text.encode().lower().split() if text else []


def shingles(words: list[bytes], size: int) -> list[bytes]:
    return [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]


def _hashes(units: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, units)), ">i8")


def _spread(hashes: np.ndarray) -> np.ndarray:
    """The 64 bits of each hash as -1 and 1."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, BITS // 8), axis=1).astype(np.int64) * 2 - 1


def _packed(votes: np.ndarray) -> np.ndarray:
    """Rows of 64 sums as BLOCKS 16-bit values: a bit is set where the sum is positive."""
    return np.packbits(votes > 0, axis=-1).view(">u2").astype(np.uint16)


_ONES = np.unpackbits(np.arange(1 << 16, dtype=">u2").view(np.uint8).reshape(-1, 2), axis=1).sum(axis=1).astype(np.uint8)


def item_shingles(text: str | None) -> list[bytes]:
    words = words_of(text)
    return shingles(words, min(SHINGLE_WORDS, len(words)))


class ItemIndex:
    """Fingerprints, shingles and the multi-index of one block of benchmark items.

    ``shared``: hashes, in order, of the shingles that several items of the
    benchmark hold, and how many hold each; without it the block is the benchmark.
    """

    def __init__(self, items: list[tuple], shared: tuple[np.ndarray, np.ndarray] | None = None):
        self.ids = [i for i, _ in items]
        words = [words_of(t) for _, t in items]
        self.lengths = [len(w) for w in words]
        self.sizes = [min(SHINGLE_WORDS, n) for n in self.lengths]
        self.counts = [Counter(shingles(w, k)) for w, k in zip(words, self.sizes)]
        self.holders: dict[bytes, list[int]] = defaultdict(list)
        for i, c in enumerate(self.counts):
            for s in c:
                self.holders[s].append(i)
        if shared is None:
            several = sorted((h, len(at)) for h, at in zip(_hashes(self.holders).tolist(), self.holders.values()) if len(at) > 1)
            shared = tuple(np.array(several, np.int64).reshape(-1, 2).T)
        self.shared, self.n_holders = shared
        self.vocabulary = {w for ws in words for w in ws}
        self.short_sizes = sorted({k for k in self.sizes if k < SHINGLE_WORDS})
        self.prints, self.owner = self._prints()
        self.by_length = self._multi_index()

    def weights(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes))
        if len(self.shared):
            at = np.minimum(np.searchsorted(self.shared, hashes), len(self.shared) - 1)
            held = self.shared[at] == hashes
            out[held] /= self.n_holders[at[held]]
        return out

    def _prints(self) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints and their items: the weighted one of each item, then the plain ones that differ."""
        if not self.counts:
            return np.empty((0, BLOCKS), np.uint16), np.empty(0, np.int64)
        pairs = [self._both_votes(list(c), np.array(list(c.values()), np.int64)) for c in self.counts]
        weighted, plain = (_packed(np.array([v.sum(axis=0) for v in votes])) for votes in zip(*pairs))
        other = np.flatnonzero((weighted != plain).any(axis=1))
        return np.vstack([weighted, plain[other]]), np.concatenate([np.arange(len(weighted)), other])

    def _multi_index(self) -> dict[int, tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]]:
        """For each item length its fingerprints, and for each block the values there, how many have each, and which, by value."""
        lengths, out = np.array(self.lengths, np.int64)[self.owner], {}
        for length in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == length)
            blocks = []
            for b in range(BLOCKS):
                values, counts = np.unique(self.prints[rows, b], return_counts=True)
                blocks.append((values, counts, np.argsort(self.prints[rows, b], kind="stable")))
            out[length] = rows, blocks
        return out

    def _both_votes(self, units: list[bytes], times: np.ndarray | int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Weighted and plain votes of each shingle, as integers, so that sums don't depend on their order."""
        hashes = _hashes(units)
        plain = _spread(hashes) * np.reshape(times, (-1, 1))
        return plain * np.rint(self.weights(hashes) * WEIGHT_ONE).astype(np.int64)[:, None], plain

    def candidates(self, fingerprint: np.ndarray, length: int) -> np.ndarray:
        """Fingerprints of items that long that differ in at most RADIUS bits, as rows of ``prints`` and ``owner``."""
        rows, blocks = self.by_length[length]
        listed = np.zeros(len(rows), bool)
        for value, (values, counts, by_value) in zip(fingerprint, blocks):
            near = _ONES[values ^ value] <= RADIUS // BLOCKS
            listed[by_value[np.repeat(near, counts)]] = True
        found = rows[listed]
        return found[_ONES[self.prints[found] ^ fingerprint].sum(axis=1, dtype=np.int64) <= RADIUS]

    def similarity(self, item: int, window: Counter) -> float:
        """The larger of weighted and plain Jaccard similarity."""
        own = self.counts[item]
        if not any(s in window for s in own):
            return 0.0
        units = [*own, *(s for s in window if s not in own)]
        both = [min(own[s], window[s]) for s in units]
        all_ = [max(own[s], window[s]) for s in units]
        weights = self.weights(_hashes(units)).tolist()
        weighted = sum(w * n for w, n in zip(weights, both)) / sum(w * n for w, n in zip(weights, all_))
        return max(weighted, sum(both) / sum(all_))

    def hits(self, words: list[bytes]) -> dict[int, list[int]]:
        """Positions of benchmark shingles, by shingle size."""
        known = np.fromiter(map(self.vocabulary.__contains__, words), bool, len(words))
        out = {}
        for size in {SHINGLE_WORDS, *self.short_sizes}:
            if len(words) < size:
                continue
            run = np.lib.stride_tricks.sliding_window_view(known, size).all(axis=1)
            if at := [p for p in np.flatnonzero(run).tolist() if b" ".join(words[p : p + size]) in self.holders]:
                out[size] = at
        return out

    def matches(self, text: str | None) -> Iterator[tuple]:
        """(item_id, similarity, first word, words) of each item's best window in a text."""
        words = words_of(text)
        best: dict[int, tuple[float, int, int]] = {}
        for size, at in self.hits(words).items():
            near = defaultdict(set)  # window length -> starts of windows that hold a shingle of an item that long
            for p in at:
                for length in {self.lengths[i] for i in self.holders[b" ".join(words[p : p + size])] if self.sizes[i] == size}:
                    wide = min(length, len(words))
                    near[length].update(range(max(0, p + size - wide), min(p, len(words) - wide) + 1))
            for length, starts in near.items():
                self._windows(words, size, length, sorted(starts), best)
        for i, (similarity, start, wide) in sorted(best.items()):
            yield self.ids[i], similarity, start, wide

    def _windows(self, words, size, length, starts, best) -> None:
        wide = min(length, len(words))
        stretch: list[int] = []
        for k, p in enumerate(starts):  # neighbouring windows share their sums
            stretch.append(p)
            if k + 1 < len(starts) and starts[k + 1] == p + 1 and len(stretch) < 4096:
                continue
            first = stretch[0]
            units = shingles(words[first : stretch[-1] + wide], size)
            per = wide - size + 1
            sums = (np.vstack([np.zeros((1, BITS), np.int64), np.cumsum(votes, axis=0)]) for votes in self._both_votes(units))
            weighted, plain = (_packed(x[per:] - x[:-per]) for x in sums)
            differ = (weighted != plain).any(axis=1)
            for o in range(len(stretch)):
                near = self.candidates(weighted[o], length)
                if differ[o]:
                    near = np.concatenate([near, self.candidates(plain[o], length)])
                found = np.unique(self.owner[near]).tolist()
                if not found:
                    continue
                window = Counter(units[o : o + per])
                for i in found:
                    s = self.similarity(i, window)
                    if 100 * s >= SIMILARITY_PCT - 1e-9 and s > best.get(i, (0.0,))[0]:
                        best[i] = (s, first + o, wide)
            stretch = []


def _items(benchmark: DataFrame) -> DataFrame:
    rows = benchmark.select("item_id", "text").where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return rows.distinct()


def shared_shingles(benchmark: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, in order, of the shingles that several items hold, and how many hold each."""

    def hashed(batches):
        for batch in batches:
            for text in batch.column("text").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(_hashes(set(item_shingles(text))).astype(np.int64))], names=["hash"])

    rows = _items(benchmark).select("text").mapInArrow(hashed, "hash long")
    found = rows.groupBy("hash").count().where(F.col("count") > 1).toArrow()
    hashes, counts = (found.column(c).to_numpy() for c in ("hash", "count"))
    order = np.argsort(hashes)
    return hashes[order], counts[order]


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """The benchmark in blocks of bounded size, read a partition at a time."""
    block, chars = [], 0
    for r in _items(benchmark).toLocalIterator():
        if block and chars + len(r.text) > BLOCK_CHARS:
            yield block
            block, chars = [], 0
        block.append((r.item_id, r.text))
        chars += len(r.text)
    if block:
        yield block


def _schema(docs: DataFrame, benchmark: DataFrame) -> str:
    id_type, item_type = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    return f"doc_id {id_type}, _tie long, {MATCH.format(item_type)}"


def _against(docs: DataFrame, items: list[tuple], holders: Broadcast, schema: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    kinds = [f.type for f in to_arrow_schema(T.StructType.fromDDL(schema))][2:]

    def search(batches):
        index = ItemIndex(shared.value, holders.value)
        for batch in batches:
            rows, found = [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                for m in index.matches(text):
                    rows.append(k)
                    found.append(m)
            columns = [pa.array([m[j] for m in found], kind) for j, kind in enumerate(kinds)]
            own = [batch.column(c).take(pa.array(rows, pa.int64())) for c in ("doc_id", "_tie")]
            yield pa.RecordBatch.from_arrays([*own, *columns], names=["doc_id", "_tie", "item_id", "similarity", "start", "n_words"])

    return docs.select("doc_id", F.xxhash64("text").alias("_tie"), "text").mapInArrow(search, schema)


def _tied_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``leaks`` with _tie, the hash of the document's text."""
    holders = docs.sparkSession.sparkContext.broadcast(shared_shingles(benchmark))
    schema = _schema(docs, benchmark)
    parts = [_against(docs, block, holders, schema) for block in item_blocks(benchmark)]
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, parts)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, start, n_words: a row for each item found in a document, at its best window."""
    return _tied_leaks(docs, benchmark).drop("_tie")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item is found, with the columns they came with."""
    found = _tied_leaks(docs, benchmark).select(F.col("doc_id").alias("_l_id"), F.col("_tie").alias("_l_tie")).distinct()
    rows = packed(docs, _id="doc_id").withColumn("_tie", F.xxhash64("_row.text"))
    return rows.join(found, F.col("_id").eqNullSafe(F.col("_l_id")) & (F.col("_tie") == F.col("_l_tie")), "left_anti").select("_row.*")
