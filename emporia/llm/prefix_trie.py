"""The prefix trie of conversations, from padded matrices of turn ids.

A turn's id are 128 bits of hash over its role and text.  Conversations are
cut into segments of ``WIDTH`` turns, so that no row and no matrix depends on
the length of a conversation.  First all first segments are sorted: they are
range partitioned by their turn ids, and each shard makes a padded matrix of
its segments, sorts it with ``numpy.lexsort`` and compares neighbouring rows.
The change masks, OR-accumulated along the turns, mark where the nodes of each
depth start, and ``reduceat`` over these starts aggregates every depth.

A node whose rows reach an edge of its shard may run on in the next one.  Such
boundary nodes (at most two paths a shard) leave as partial sums under a hash of
their path and are merged; their own terms then go to their ancestors of the
same segment.  Turn numbers never decide a shard: a first turn that a third of
all conversations share runs on over a third of the shards.

Where several conversations still agree at the end of a segment, their next
segments form the subtrie below that node, and the same step runs again for
these conversations only; its totals are then added along the path above.  A
conversation that is alone has one node a turn and needs no sorting: these
nodes are written out from its length.

Cases: a null role or text counts as empty; rows without a conversation id
belong to none and are left out; turns of a conversation are ordered by their
number, null first, turns of one number by their ids (repeated rows are two
equal turns); a conversation without turns is a member of the root only; texts
of any length are read once, for their hash; an empty table gives an empty
result; columns of other names are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.llm.common import ranked, staged

WIDTH = 64
SHARD_ROWS = 16384
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_MULT, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def turn_ids(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, t1, t2, n_bytes, n_turns) of every turn, and (conv_id, n_turns), of rows (conv_id, turn, role, text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), F.xxhash64(F.lit(1), role, text).alias("t1"), F.xxhash64(F.lit(2), text, role).alias("t2"), F.octet_length(text).alias("n_bytes")
    )
    rows = ranked(named, "conv_id", ["turn", "t1", "t2"], "turns").select("conv_id", F.col("_pos").alias("pos"), "t1", "t2", "n_bytes", F.col("_size").alias("n_turns"))
    rows = staged(rows, "turn-ids")
    return rows, rows.where(F.col("pos") == 0).select("conv_id", "n_turns")


def segments(turns: DataFrame, convs: DataFrame, turns_each: int = WIDTH) -> DataFrame:
    """conv_id, seg, ids (16 bytes a turn, big-endian), sizes, more (does it go on) of every segment; a conversation without turns has one empty segment."""
    big = F.unhex(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in ("t1", "t2")]))
    grouped = turns.groupBy("conv_id", F.expr(f"pos div {turns_each}").alias("seg")).agg(F.array_sort(F.collect_list(F.struct("pos", big.alias("id"), "n_bytes"))).alias("s"), F.max("n_turns").alias("n_turns"))
    ids = F.aggregate("s", F.lit(b""), lambda whole, t: F.concat(whole, t.id))
    cut = grouped.select("conv_id", "seg", ids.alias("ids"), F.col("s.n_bytes").alias("sizes"), (F.col("n_turns") > (F.col("seg") + 1) * turns_each).alias("more"))
    none = convs.where(F.col("n_turns") == 0).select("conv_id", F.lit(0).cast("long").alias("seg"), F.lit(b"").alias("ids"), F.array().cast("array<int>").alias("sizes"), F.lit(False).alias("more"))
    return cut.unionByName(none)


# ---- one shard ---------------------------------------------------------------

def _matrix(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Turn ids as a padded matrix (rows, turns, 2) and the rows' lengths."""
    length = np.fromiter((len(p) // 16 for p in parts), np.int64, len(parts))
    out = np.zeros((len(parts), int(length.max(initial=0)), 2), np.uint64)
    flat = np.frombuffer(b"".join(parts), ">u8").astype(np.uint64).reshape(-1, 2)
    row = np.repeat(np.arange(len(parts)), length)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)] = flat
    return out, length


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (np.asarray(b) * _MULT)) * _MIX
    return (x ^ (x >> np.uint64(31))) * _MULT


def _path_hashes(root: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """128-bit hashes of every row's path down to each depth, (rows, turns + 1, 2)."""
    out = np.empty((len(root), ids.shape[1] + 1, 2), np.uint64)
    out[:, 0, 0], out[:, 0, 1] = _mixed(root, np.uint64(3)), _mixed(root, np.uint64(5))
    for j in range(ids.shape[1]):
        for k in range(2):
            out[:, j + 1, k] = _mixed(_mixed(out[:, j, k], ids[:, j, 0]), ids[:, j, 1] ^ np.uint64(k))
    return out


def _shard(root: np.ndarray, conv: np.ndarray, parts: list[bytes], sizes: list, more: np.ndarray, shard: int, turns_each: int) -> Iterator[dict]:
    """Column dicts of the nodes of one shard, one per depth; boundary nodes are partial."""
    ids, length = _matrix(parts)
    n, width = len(conv), ids.shape[1]
    columns = [ids[:, j, k] for j in range(width) for k in range(2)]
    # shorter rows first: padding counts as a value below all ids; of equal rows, those that end come before those that go on
    present = [j < length for j in range(width)]
    keys = [c for j in range(width) for c in (present[j], columns[2 * j], columns[2 * j + 1])]
    order = np.lexsort((conv, more, *reversed(keys), root))
    root, conv, ids, length, more = root[order], conv[order], ids[order], length[order], more[order]
    byte = np.zeros((n, width), np.int64)
    flat = np.concatenate([np.asarray(sizes[i], np.int64) for i in order]) if width else np.empty(0, np.int64)
    row = np.repeat(np.arange(n), length)
    byte[row, np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)] = flat
    step = np.zeros((n, width + 1), bool)
    step[0] = True
    step[1:, 0] = root[1:] != root[:-1]
    step[1:, 1:] = (ids[1:] != ids[:-1]).any(axis=2) | ((np.arange(width) < length[1:, None]) != (np.arange(width) < length[:-1, None]))
    change = np.logical_or.accumulate(step, axis=1)
    start = change & (np.arange(width + 1) <= length[:, None])
    hashes = _path_hashes(root.view(np.uint64), ids)

    nodes = []
    for j in range(width + 1):
        at = np.flatnonzero(start[:, j])
        # a node ends where any of its first j turns changes
        cut = np.flatnonzero(change[:, j])
        end = np.r_[cut, n][np.searchsorted(cut, at, "right")]
        nodes.append((at, end, (at == 0) | (end == n)))
    least, total = [], []
    for j, (at, end, _) in enumerate(nodes):
        # the node that a layer starts from has its name already
        least.append(_reduced(np.minimum, conv, at, end) if j else root[at])
        total.append(end - at)
    closed = start.astype(np.int64)
    for j, (at, _, open_) in enumerate(nodes):
        closed[at[open_], j] = 0
    children = [_reduced(np.add, closed[:, j + 1], at, end) if j < width else 0 * at for j, (at, end, _) in enumerate(nodes)]
    onward = [_reduced(np.add, (more & (length == turns_each)).astype(np.int64), at, end) if j == turns_each else 0 * at for j, (at, end, _) in enumerate(nodes)]
    # what each row starts, from its deepest turn up; boundary nodes add their own terms when they are whole
    leaf, saved = np.zeros((n, width + 2), np.int64), np.zeros((n, width + 2), np.int64)
    for j, (at, end, open_) in enumerate(nodes):
        leaf[at, j] = ~open_ & (children[j] == 0) & (onward[j] < 2)
        saved[at, j] = np.where(open_ | (j == 0), 0, (total[j] - 1) * byte[at, max(j, 1) - 1] if width else 0)
    leaf, saved = (np.cumsum(x[:, ::-1], axis=1)[:, ::-1] for x in (leaf, saved))
    parent_of = np.zeros(n, np.int64)
    parent_open = np.zeros(n, bool)
    for j, (at, end, open_) in enumerate(nodes):
        ends = _reduced(np.add, (length == j).astype(np.int64) * ~(more & (length == turns_each)), at, end)
        # rows that end at a node come first in it, in the order of their ids
        texts = [",".join(map(str, conv[a : a + e].tolist())) for a, e in zip(at.tolist(), ends.tolist())]
        kind = np.where(open_, 1, 0)
        yield {
            "shard": np.full(len(at), shard), "open": kind, "root": root[at], "level": np.full(len(at), j), "h1": hashes[at, j, 0].view(np.int64), "h2": hashes[at, j, 1].view(np.int64),
            "p1": hashes[at, max(j, 1) - 1, 0].view(np.int64), "p2": hashes[at, max(j, 1) - 1, 1].view(np.int64),
            "conv_id": least[j], "parent": parent_of[at] if j else root[at], "parent_open": parent_open[at] if j else np.zeros(len(at), bool),
            "n_convs": total[j], "n_children": children[j], "onward": onward[j], "n_bytes": byte[at, j - 1] if j else 0 * at, "n_leaves": _reduced(np.add, leaf[:, j], at, end), "saved": _reduced(np.add, saved[:, j], at, end),
            "first_end": np.where(ends > 0, conv[at], np.iinfo(np.int64).max),
            "ends": [t if o else hashlib.sha256(t.encode()).hexdigest() for t, o in zip(texts, open_.tolist())],
            # paths are only needed above what goes on and above boundary nodes
            "path": [hashes[a, : j + 1].view(np.int64).ravel() if o or m > 1 else None for a, o, m in zip(at.tolist(), open_.tolist(), onward[j].tolist())],
        }
        span = np.repeat(np.arange(len(at)), end - at)
        covered = np.concatenate([np.arange(a, e) for a, e in zip(at, end)]) if len(at) else np.empty(0, np.int64)
        parent_of[covered], parent_open[covered] = least[j][span], open_[span]


def _reduced(op, values: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``op`` over the stretches [at, end) of ``values``, by reduceat."""
    if not len(at):
        return np.empty(0, np.int64)
    bounds = np.ravel(np.column_stack([at, np.minimum(end, len(values) - 1)]))
    out = op.reduceat(values, bounds)[::2]
    # the last stretch may run to the end of the values, which no index can name
    last = end == len(values)
    if last.any():
        out = out.copy()
        out[last] = [op.reduce(values[a:]) for a in at[last]]
    return out


_FIELDS = [(n, pa.int64()) for n in ("shard", "open", "root", "level", "h1", "h2", "p1", "p2", "conv_id", "parent")] + [("parent_open", pa.bool_())]
_FIELDS += [(n, pa.int64()) for n in ("n_convs", "n_children", "onward", "n_bytes", "n_leaves", "saved", "first_end")] + [("ends", pa.string()), ("path", pa.list_(pa.int64()))]
_SCHEMA = "shard long, open long, root long, level long, h1 long, h2 long, p1 long, p2 long, conv_id long, parent long, parent_open boolean, n_convs long, n_children long, onward long, n_bytes long, n_leaves long, saved long, first_end long, ends string, path array<long>"


def _tiles(batches, most: int):
    """Stretches of a shard's sorted rows, of at most ``most`` rows, as matrices' contents."""
    held: list[pa.RecordBatch] = []
    rows, tile = 0, 0
    for batch in batches:
        for i in range(0, batch.num_rows, most):
            part = batch.slice(i, most)
            if rows and rows + part.num_rows > most:
                yield tile, pa.Table.from_batches(held)
                held, rows, tile = [], 0, tile + 1
            held.append(part)
            rows += part.num_rows
    if rows:
        yield tile, pa.Table.from_batches(held)


def _shards(batches, turns_each: int, most: int):
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    for tile, t in _tiles(batches, most):
        cols = {c: t.column(c).to_numpy() for c in ("root", "conv_id", "more")}
        for out in _shard(cols["root"], cols["conv_id"], t.column("ids").to_pylist(), t.column("sizes").to_pylist(), cols["more"].astype(bool), (task << 32) + tile, turns_each):
            yield pa.RecordBatch.from_arrays([pa.array(out[n], kind) for n, kind in _FIELDS], names=[n for n, _ in _FIELDS])


# ---- boundary nodes ------------------------------------------------------------

def _ends_hashed(pieces: DataFrame) -> DataFrame:
    """h1, h2, ends: the hash of a boundary node's ids, read as a sorted stream of its shards' pieces."""

    def run(batches):
        key, sha, any_ = None, hashlib.sha256(), False
        for batch in batches:
            out = []
            for h1, h2, text in zip(*(batch.column(c).to_pylist() for c in ("h1", "h2", "ends"))):
                if (h1, h2) != key:
                    if key:
                        out.append((*key, sha.hexdigest()))
                    key, sha, any_ = (h1, h2), hashlib.sha256(), False
                if text:
                    sha.update((("," if any_ else "") + text).encode())
                    any_ = True
            yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["h1", "h2", "ends"]), schema=schema, preserve_index=False)
        if key:
            yield pa.RecordBatch.from_pandas(pd.DataFrame([(*key, sha.hexdigest())], columns=["h1", "h2", "ends"]), schema=schema, preserve_index=False)

    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("ends", pa.string())])
    stream = pieces.select("h1", "h2", "first_end", "ends").repartition("h1", "h2").sortWithinPartitions("h1", "h2", "first_end")
    return stream.mapInArrow(run, "h1 long, h2 long, ends string")


def _pairs(path: str = "path") -> Column:
    """The hashes of a path as (h1, h2) structs."""
    at = F.sequence(F.lit(0), F.expr(f"cast(size({path}) div 2 - 1 as int)"))
    return F.transform(at, lambda i: F.struct(F.get(path, 2 * i).alias("h1"), F.get(path, 2 * i + 1).alias("h2")))


def _merged(parts: DataFrame) -> DataFrame:
    """The boundary nodes made whole: the columns of a node, path, and h1, h2."""
    whole = parts.groupBy("h1", "h2").agg(
        *[F.first(c).alias(c) for c in ("root", "level", "p1", "p2", "n_bytes", "path")], F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "onward", "n_leaves", "saved")],
    )
    whole = staged(whole.join(_ends_hashed(parts), ["h1", "h2"]), "boundary-nodes")
    below = whole.where(F.col("level") > 0).groupBy(F.col("p1").alias("h1"), F.col("p2").alias("h2")).agg(F.count(F.lit(1)).alias("open_children"))
    whole = whole.join(below, ["h1", "h2"], "left").withColumn("n_children", F.col("n_children") + F.coalesce("open_children", F.lit(0))).drop("open_children")
    # a boundary node's own terms count for itself and for all above it
    own_leaf = ((F.col("n_children") == 0) & (F.col("onward") < 2)).cast("long")
    own_saved = F.when(F.col("level") > 0, (F.col("n_convs") - 1) * F.col("n_bytes")).otherwise(0)
    terms = whole.select(own_leaf.alias("own_leaf"), own_saved.alias("own_saved"), F.explode(_pairs()).alias("up"))
    terms = terms.groupBy("up.h1", "up.h2").agg(F.sum("own_leaf").alias("own_leaf"), F.sum("own_saved").alias("own_saved"))
    whole = whole.join(terms, ["h1", "h2"]).withColumn("n_leaves", F.col("n_leaves") + F.col("own_leaf")).withColumn("saved", F.col("saved") + F.col("own_saved"))
    above = whole.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv_id").alias("above"))
    whole = whole.join(above, ["p1", "p2"], "left")
    return whole.withColumn("parent", F.when(F.col("level") == 0, F.col("root")).otherwise(F.col("above"))).drop("above", "own_leaf", "own_saved")


_NODE_COLUMNS = ("h1", "h2", "root", "level", "conv_id", "parent", "n_convs", "n_children", "onward", "n_leaves", "saved", "ends", "path")


def _layer(rows: DataFrame, turns_each: int, most: int) -> DataFrame:
    """The nodes of one layer of segments (root, conv_id, ids, sizes, more), those of level 0 included."""
    shards = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // most))
    by = ("root", "ids", "more", "conv_id")
    dealt = rows.repartitionByRange(shards, *by).sortWithinPartitions(*by)
    found = staged(dealt.mapInArrow(lambda batches: _shards(batches, turns_each, most), _SCHEMA), "trie-shards")
    partial = found.where(F.col("open") == 1)
    whole = staged(_merged(partial), "trie-boundary")
    closed = found.where(F.col("open") == 0)
    # nodes below a boundary node learn its smallest member, within their shard
    seen = partial.select("shard", "h1", "h2").join(whole.select("h1", "h2", F.col("conv_id").alias("above")), ["h1", "h2"])
    seen = seen.select("shard", F.col("h1").alias("p1"), F.col("h2").alias("p2"), "above")
    below = closed.where("parent_open").join(seen, ["shard", "p1", "p2"]).withColumn("parent", F.col("above"))
    return staged(closed.where("not parent_open").select(*_NODE_COLUMNS).unionByName(below.select(*_NODE_COLUMNS)).unionByName(whole.select(*_NODE_COLUMNS)), "trie-layer")


def _with_below(nodes: DataFrame, subtries: DataFrame) -> DataFrame:
    """A layer's nodes with the totals (conv_id, n_children, n_leaves, saved) of the subtries that go on below it."""
    joint = nodes.where(F.col("onward") > 1).select("conv_id", "path", "h1", "h2").join(subtries, "conv_id")
    up = joint.select(F.explode(_pairs()).alias("u"), "n_leaves", "saved").groupBy("u.h1", "u.h2").agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    own = joint.select("h1", "h2", F.col("n_children").alias("more_children"))
    nodes = nodes.join(up, ["h1", "h2"], "left").join(own, ["h1", "h2"], "left")
    zero = F.lit(0)
    return nodes.select(
        *[c for c in _NODE_COLUMNS if c not in ("n_children", "n_leaves", "saved")], (F.col("n_children") + F.coalesce("more_children", zero)).alias("n_children"),
        (F.col("n_leaves") + F.coalesce("more_leaves", zero)).alias("n_leaves"), (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved"),
    )


def _alone(nodes: DataFrame, members: DataFrame, depth: int, turns_each: int) -> DataFrame:
    """The further nodes of conversations that are the only one to go on below a node at ``depth`` turns.

    members: (conv_id, n_turns, root, h1, h2) of the conversations that go on, with the node they go on from.
    """
    node = nodes.where((F.col("level") == turns_each) & (F.col("onward") == 1)).select("h1", "h2", F.col("conv_id").alias("above"))
    one = members.join(node, ["h1", "h2"]).select("conv_id", "n_turns", "above")
    # turn by turn in bounded stretches: no array is as long as a conversation
    far = one.withColumn("at", F.explode(F.sequence(F.lit(depth).cast("long"), F.col("n_turns") - 1, F.lit(turns_each).cast("long"))))
    far = far.withColumn("depth", F.explode(F.sequence(F.col("at") + 1, F.least(F.col("at") + turns_each, F.col("n_turns")))))
    last = F.col("depth") == F.col("n_turns")
    ends = F.when(last, F.col("conv_id").cast("string")).otherwise("")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    return far.select(
        "conv_id", "depth", F.when(F.col("depth") == depth + 1, F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"), one.alias("n_convs"),
        F.when(last, zero).otherwise(one).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"), F.sha2(ends, 256).alias("ends_sha256"),
    )


def trie(turns: DataFrame, convs: DataFrame, turns_each: int = WIDTH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Every node of the trie of ``turns`` (conv_id, pos, t1, t2, n_bytes, n_turns) and ``convs`` (conv_id, n_turns).

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256 (SHA-256 of the ids, comma
    joined, of the members that end there).  ``turns_each``: turns of a segment;
    ``shard_rows``: rows of a matrix.
    """
    cut = staged(segments(turns, convs, turns_each), "segments")
    first = convs.agg(F.min("conv_id")).first()[0]
    rows = cut.where(F.col("seg") == 0).withColumn("root", F.lit(first).cast("long"))
    layers, alone, seg = [], [], 0
    while True:
        nodes = _layer(rows, turns_each, shard_rows)
        layers.append(nodes)
        going = nodes.where((F.col("level") == turns_each) & (F.col("onward") > 0))
        if going.isEmpty():
            break
        depth = (seg + 1) * turns_each
        members = staged(_members(rows), "trie-members")
        lengths = convs.select(F.col("conv_id").alias("c"), "n_turns")
        alone.append(_alone(nodes, members.join(lengths, F.col("conv_id") == F.col("c")), depth, turns_each))
        shared = going.where(F.col("onward") > 1).select("h1", "h2", F.col("conv_id").alias("root"))
        seg += 1
        onward = members.join(shared, ["h1", "h2"]).select(F.col("conv_id").alias("c"), "root")
        rows = staged(cut.where(F.col("seg") == seg).join(onward, F.col("conv_id") == F.col("c")).drop("c"), "trie-rows")
        if rows.isEmpty():
            break
    # totals from the deepest layer up
    below = None
    out = []
    for seg, nodes in reversed(list(enumerate(layers))):
        if below is not None:
            nodes = staged(_with_below(nodes, below), "trie-totals")
        kept = nodes if seg == 0 else nodes.where(F.col("level") > 0)
        root = (F.col("level") == 0) & F.lit(seg == 0)
        children = F.col("n_children") + (F.col("onward") == 1).cast("long")
        out.append(kept.select(
            "conv_id", (F.col("level") + seg * turns_each).alias("depth"), F.when(~root, F.col("parent")).alias("parent_conv_id"), "n_convs", children.alias("n_children"), "n_leaves",
            F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
        ))
        below = nodes.where(F.col("level") == 0).select("conv_id", "n_children", "n_leaves", "saved")
    for d in out[1:] + alone:
        out[0] = out[0].unionByName(d)
    return out[0]


def _members(rows: DataFrame) -> DataFrame:
    """conv_id, h1, h2: of the rows that go on, the node at the end of their segment."""

    def hashed(batches):
        for batch in batches:
            ids, _ = _matrix(batch.column("ids").to_pylist())
            h = _path_hashes(batch.column("root").to_numpy().view(np.uint64), ids)[:, -1].view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(h[:, 0]), pa.array(h[:, 1])], names=["conv_id", "h1", "h2"])

    return rows.where("more").select("conv_id", "root", "ids").mapInArrow(hashed, "conv_id long, h1 long, h2 long")


def rebuilt(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of another one: (turns, convs) of the same columns.

    Conversation c takes the first h turns, h = crc32(c) % 9, of conversation
    c - c % 5 as far as there are any, then its own turns after its first h.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    base = convs.select(F.col("conv_id").alias("b"), F.col("n_turns").alias("n_base"))
    plan = convs.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % 5)
    plan = plan.join(base, F.col("base") == F.col("b"), "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    plan = staged(plan.select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).alias("n_turns")), "rebuilt-plan")
    heads = turns.where(F.col("pos") < 8).select(F.col("conv_id").alias("b"), "pos", "t1", "t2", "n_bytes")
    taken = plan.select("conv_id", "base", "taken", "n_turns").join(heads, F.col("base") == F.col("b")).where(F.col("pos") < F.col("taken")).select("conv_id", "pos", "t1", "t2", "n_bytes", "n_turns")
    # the longest conversations may hold a large share of the rows: their own part is joined by its stretch
    stretch = F.expr(f"pos div {1 << 16}")
    own = plan.select(F.col("conv_id").alias("c"), "h", "taken", "n_turns", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n_turns + 8) div {1 << 16}"))).alias("s"))
    rest = turns.drop("n_turns").withColumn("at", stretch).join(own, (F.col("conv_id") == F.col("c")) & (F.col("at") == F.col("s"))).where(F.col("pos") >= F.col("h"))
    rest = rest.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "t1", "t2", "n_bytes", "n_turns")
    return taken.unionByName(rest), plan.select("conv_id", "n_turns")
