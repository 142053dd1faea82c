"""Merkle manifest of a dataset: a hash tree over its rows, with every row's proof.

Rows are leaves.  The leaves of a group (here: a language) ascend by key; while
several nodes remain, every ``FANOUT`` consecutive ones become the hash of
their digests, and what remains is the group's subroot.  The subroots, ordered
by group, are the leaves of one more such tree, whose top is the root.

A group's leaves are cut into aligned blocks of ``BLOCK`` leaves, each hashed
by one task.  The blocks then run a butterfly exchange: in round r a block gets
the subtree roots of the up to ``FANOUT`` neighbouring aligned groups of
``FANOUT ** r`` blocks, each from one block of that group, and hashes their
parent itself.  All blocks of a group hash the same ancestors, so each has its
whole upper proof when the last round ends, and nothing is sent back down.  A
round moves at most ``FANOUT`` digests a block.  Blocks next to a group's
ragged end, whose partner doesn't exist, are spread over the blocks there are.

Cases: a null field is ``-`` in a leaf, an empty text has length 0; texts of
any length are hashed where they are and never moved; rows with one key are
ordered by their leaf digests, so repeated rows stay apart and are exchangeable;
a row without a key comes first in its group; rows without a group form a
group, which comes first; a group of one row has its leaf as subroot and no
siblings; an empty table gives an empty result; columns of any name beyond the
hashed ones are ignored unless they are carried.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import ranked, staged, with_keyed

FANOUT = 8
BLOCK = FANOUT**3
PATH = "array<struct<left: string, right: string>>"


def digest(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def leaf_digest(fields: list[Column]) -> Column:
    """A row's leaf: the digest of its fields, each as byte count, colon and value."""

    def part(field: Column) -> Column:
        text = field.cast("string")
        return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*map(part, fields)), 256)


def levels(nodes: list[str], inner: bool) -> list[list[str]]:
    """A block's nodes from its leaves up to its top; a block that is all of its group ends where one node remains."""
    out = [nodes]
    while len(out[-1]) > 1 if not inner else len(out) <= 3:
        out.append([digest(out[-1][i : i + FANOUT]) for i in range(0, len(out[-1]), FANOUT)])
    return out


def _blocks(leaves: DataFrame, name: str) -> DataFrame:
    """grp, block, n_blocks, rows (pos, leaf, row) of leaves (grp, leaf, row, _pos, _size); a block is a row of bounded size."""
    placed = leaves.select("grp", F.expr(f"_pos div {BLOCK}").alias("block"), F.expr(f"(_size - 1) div {BLOCK} + 1").alias("n_blocks"), F.struct(F.col("_pos").alias("pos"), "leaf", "row").alias("r"))
    return staged(placed.groupBy("grp", "block", "n_blocks").agg(F.array_sort(F.collect_list("r")).alias("rows")), name)


def _tops(blocks: DataFrame) -> DataFrame:
    """grp, block, n_blocks, node of every block."""

    def hashed(batches):
        for batch in batches:
            leaves = batch.column("leaves").to_pylist()
            tops = [levels(n, many > 1)[-1][0] for n, many in zip(leaves, batch.column("n_blocks").to_pylist())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("grp", "block", "n_blocks")], pa.array(tops, pa.string())], names=["grp", "block", "n_blocks", "node"])

    return blocks.select("grp", "block", "n_blocks", F.col("rows.leaf").alias("leaves")).mapInArrow(hashed, "grp string, block long, n_blocks long, node string")


def butterfly(blocks: DataFrame, name: str) -> DataFrame:
    """grp, block, node (the group's subroot), up (the block's path to it, from below) of every block."""
    state = staged(_tops(blocks).withColumn("up", F.array().cast(PATH)), name)
    most = state.agg(F.max("n_blocks")).first()[0] or 0
    done, width = [], 1
    while True:
        nodes = F.expr(f"(n_blocks - 1) div {width} + 1")
        done.append(state.where(nodes == 1))
        if -(-most // width) <= 1:
            break
        state = staged(_exchange(state.where(nodes > 1).withColumn("nodes", nodes), width), name)
        width *= FANOUT
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("grp", "block", "node", "up")


def _exchange(state: DataFrame, width: int) -> DataFrame:
    """One round: every block gets the nodes of its aligned neighbours of ``width`` blocks and hashes their parent."""
    own = F.expr(f"block div {width}")
    first = F.expr(f"block div {width * FANOUT} * {FANOUT}")
    asked = state.select("grp", "block", "n_blocks", "up", own.alias("own"), F.explode(F.sequence(first, F.least(first + (FANOUT - 1), F.col("nodes") - 1))).alias("sibling"))
    there = F.least(F.lit(width), F.col("n_blocks") - F.col("sibling") * width)
    asked = asked.withColumn("partner", F.col("sibling") * width + F.pmod(F.col("block") % width, there))
    sent = state.select(F.col("grp").alias("g"), F.col("block").alias("b"), "node")
    got = asked.join(sent, (F.col("grp") == F.col("g")) & (F.col("partner") == F.col("b")))
    run = F.array_sort(F.collect_list(F.struct("sibling", "node")))
    got = got.groupBy("grp", "block", "n_blocks", "own").agg(run.alias("run"), F.first("up").alias("up"))

    def joined(keep) -> Column:
        return F.array_join(F.transform(F.filter("run", keep), lambda s: s.node), "")

    step = F.struct(joined(lambda s: s.sibling < F.col("own")).alias("left"), joined(lambda s: s.sibling > F.col("own")).alias("right"))
    return got.select("grp", "block", "n_blocks", F.sha2(joined(lambda s: F.lit(True)), 256).alias("node"), F.concat("up", F.array(step)).alias("up"))


def _proofs(blocks: DataFrame, ups: DataFrame) -> DataFrame:
    """leaf, row, path of every row, with the other columns of ``ups`` (grp, block, up, ...), which has one row a block."""
    rest = [c for c in ups.columns if c not in ("grp", "block", "up")]
    both = blocks.join(ups.select(F.col("grp").alias("g"), F.col("block").alias("b"), "up", *rest), (F.col("grp") == F.col("g")) & (F.col("block") == F.col("b")))
    both = both.select("grp", "n_blocks", "up", "rows", *rest)
    row = blocks.schema["rows"].dataType.elementType["row"].dataType.simpleString()
    kept = ", ".join(f"{c} {ups.schema[c].dataType.simpleString()}" for c in rest)
    step = pa.struct([("left", pa.string()), ("right", pa.string())])

    def paths(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                yield from of_block(batch.slice(k, 1))

    def of_block(block):
        rows = block.column("rows").flatten()
        leaves = rows.field("leaf")
        below = levels(leaves.to_pylist(), block.column("n_blocks")[0].as_py() > 1)
        up = block.column("up")[0].as_py()
        local = []
        for i in range(len(leaves)):
            path, at = [], i
            for nodes in below[:-1]:
                run = at - at % FANOUT
                path.append({"left": "".join(nodes[run:at]), "right": "".join(nodes[at + 1 : run + FANOUT])})
                at //= FANOUT
            local.append(path + up)
        same = [pa.array([block.column(c)[0].as_py()] * len(leaves), block.column(c).type) for c in ["grp", *rest]]
        yield pa.RecordBatch.from_arrays([leaves, rows.field("row"), pa.array(local, pa.list_(step)), *same], names=["leaf", "row", "path", "grp", *rest])

    return both.mapInArrow(paths, f"leaf string, row {row}, path {PATH}, grp string" + (f", {kept}" if kept else ""))


def manifest(rows: DataFrame, fields: list[str], group: str, key: str, carry: list[str] = []) -> DataFrame:
    """key, leaf, subroot, root, path (left and right siblings, from the leaf up) and the carried columns of every row."""
    named = [key, *[c for c in carry if c != key]]
    leaves = rows.select(
        # a group's name sorts bytewise, and no group comes before all of them
        F.when(F.col(f"`{group}`").isNull(), "").otherwise(F.concat(F.lit("="), F.col(f"`{group}`").cast("string"))).alias("grp"),
        F.col(f"`{key}`").alias("key"), leaf_digest([F.col(f"`{c}`") for c in fields]).alias("leaf"),
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(named)]).alias("row"),
    )
    blocks = _blocks(ranked(leaves, "grp", ["key", "leaf"], "manifest-leaves"), "manifest-blocks")
    lower = butterfly(blocks, "manifest-rounds")
    lower = staged(lower, "manifest-subroots")
    subroots = lower.where(F.col("block") == 0).select(F.lit("").alias("grp"), F.col("node").alias("leaf"), F.struct(F.col("grp").alias("name")).alias("row"), F.col("grp").alias("key"))
    top_blocks = _blocks(ranked(subroots, "grp", ["key"], "manifest-groups"), "manifest-top-blocks")
    top = staged(_proofs(top_blocks, butterfly(top_blocks, "manifest-top-rounds").withColumnRenamed("node", "root")).select(F.col("row.name").alias("grp"), F.col("path").alias("above"), "root"), "manifest-top")
    ups = with_keyed(lower, top, "grp").select("grp", "block", F.concat("up", "above").alias("up"), F.col("node").alias("subroot"), "root")
    found = _proofs(blocks, ups)
    return found.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(named)], "leaf", "subroot", "root", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to with the siblings of its path."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s.left, node, s.right), 256))


def siblings(path: Column) -> Column:
    """All digests of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s.left, s.right)), "")
