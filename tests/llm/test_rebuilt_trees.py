"""Prefix trie, SimHash and Merkle manifest against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from emporia.llm import merkle, prefix_trie, queries, simhash
from emporia.llm.common import ranked
from emporia.sources.tables import table

TURNS = "conv_id long, turn long, role string, text string, root string, _pos long"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, _pos long, fp string"


# ---- prefix trie ---------------------------------------------------------------

def whole_conversations(rows):
    own = defaultdict(list)
    for r in rows:
        if r.conv_id is not None:
            own[r.conv_id].append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    return {c: [t[2:] for t in sorted(v)] for c, v in own.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, rows = defaultdict(list), []
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) if children[p] else 1
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        saved[p] = own + sum(saved[k] for k in children[p])
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        rows.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=repr)


def trie_rows(df):
    names = [f.split()[0] for f in prefix_trie.NODE.split(", ")]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def conversations(seed, n=60):
    """Conversations that share beginnings of all lengths, copies and a few words for all turns."""
    rng = random.Random(seed)
    out = {}
    for c in range(n):
        if c and rng.random() < 0.6:
            base = out[rng.choice(sorted(out))]
            turns = base[: rng.randint(0, len(base))] + [rng.choice("abé") for _ in range(rng.choice([0, 0, 1, 5]))]
        else:
            turns = [rng.choice("ab") for _ in range(rng.choice([1, 2, 3, 4, 7, 8, 9, 12, 20]))]
        out[c * rng.choice([1, 3])] = turns or ["a"]
    return out


@pytest.mark.parametrize("width,rows", [(64, 16384), (4, 16384), (3, 2)])
def test_trie_equals_brute_force_with_short_segments_and_small_shards(spark, width, rows):
    whole = conversations(width * 7 + rows)
    data = [(c, i, "user" if i % 2 else "bot", t, "x", 0) for c, turns in whole.items() for i, t in enumerate(turns)]
    df = spark.createDataFrame(data, TURNS)
    turns, convs = prefix_trie.turn_ids(df)
    assert trie_rows(prefix_trie.trie(turns, convs, width, rows)) == brute_trie(whole_conversations(df.collect()))
    assert trie_rows(prefix_trie.trie(*prefix_trie.rebuilt(turns, convs), width, rows)) == brute_trie(rebuilt(whole_conversations(df.collect())))


def test_trie_of_the_given_table(spark, sf_dir):
    want = brute_trie(rebuilt(whole_conversations(table(spark, sf_dir, "conversations").collect())))
    assert trie_rows(queries.QUERIES["op11_prefix_trie"](spark, sf_dir)) == want


def test_trie_edge_cases(spark):
    data = [(7, None, None, None, "x", 0), (7, 1, "u", "é" * 50000, "x", 0), (7, 1, "u", "é" * 50000, "x", 0), (None, 0, "u", "lost", "x", 0)]
    data += [(8, None, "", "", "x", 0), (-3, 5, "u", "t", "x", 0)] + [(9, i, "u", f"turn {i}", "x", 0) for i in range(200)]
    data += [(10**15, i, "u", f"turn {i}" if i < 150 else "other", "x", 0) for i in range(200)]
    df = spark.createDataFrame(data, TURNS)
    assert trie_rows(prefix_trie.trie(*prefix_trie.turn_ids(df))) == brute_trie(whole_conversations(df.collect()))
    # conversations of which the rebuilt form has no turns are members of the root only
    got = trie_rows(prefix_trie.trie(*prefix_trie.rebuilt(*prefix_trie.turn_ids(df.where("conv_id in (7, 8)")))))
    assert got == brute_trie(rebuilt(whole_conversations(df.where("conv_id in (7, 8)").collect())))
    assert prefix_trie.trie(*prefix_trie.rebuilt(*prefix_trie.turn_ids(df.limit(0)))).count() == 0


def test_ranked_places_rows_of_a_group_over_many_partitions(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("g"), F.col("id").alias("o"))
    got = ranked(df, "g", ["o"], "t-ranked").where("g = 'hot'").orderBy("o").collect()
    assert [r["_pos"] for r in got] == list(range(334)) and {r["_size"] for r in got} == {334}


# ---- SimHash ---------------------------------------------------------------------

def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def reach(pairs, nodes):
    least = {n: n for n in nodes}
    def top(n):
        while least[n] != n:
            least[n] = least[least[n]]
            n = least[n]
        return n
    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        least[b] = a
    return {n: top(n) for n in nodes}


def brute_links(fps):
    f = np.array(fps, np.uint64)
    return [(i, j) for i in range(len(f)) for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= 4).tolist() if i < j]


def test_fingerprints_equal_the_definition(monkeypatch):
    texts = [None, "", " \t\n", "one", "One TWO three", "a b c d", "a b c d e f g", "É\x0bé\x0cx y z Z", "word " * 500, "x" * 5000, "a b c a b c a b c"]
    texts.append(" ".join(random.Random(3).choices("abcdef", k=3000)))
    want = [plain_fingerprint(t) for t in texts]
    for size in (simhash.SLICE_BYTES, 64, 5, 1):
        monkeypatch.setattr(simhash, "SLICE_BYTES", size)
        assert [simhash.fingerprint(None if t is None else t.encode()) for t in texts] == want


@pytest.mark.parametrize("cell,pairs", [(100_000, 1 << 21), (3, 1 << 21), (100_000, 20)])
def test_anchors_lose_no_link(spark, cell, pairs):
    rng = random.Random(cell + pairs)
    fps = {0, (1 << 64) - 1}
    for _ in range(60):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 30])):
            fps.add(x)
            x ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 3, 4, 4, 5, 5, 6])))
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    got = simhash.links(df, cell, pairs).collect()
    index = {int(np.uint64(f).view(np.int64)): i for i, f in enumerate(fps)}
    pairs_got = [(index[r.a], index[r.b]) for r in got]
    want = brute_links(fps)
    assert reach(pairs_got, range(len(fps))) == reach(want, range(len(fps)))
    assert len(want) > 100


def test_near_duplicates_equal_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in docs]
    at = reach(brute_links(fps), range(len(docs)))
    least = defaultdict(list)
    for i, r in enumerate(docs):
        least[at[i]].append(r.doc_id)
    want = sorted((r.doc_id, f"{fps[i]:016x}", min(least[at[i]])) for i, r in enumerate(docs))
    assert sorted(map(tuple, queries.QUERIES["op12_simhash"](spark, sf_dir).collect())) == want
    assert any(d != c for d, _, c in want)


def test_simhash_edge_cases(spark):
    prose = "the quick brown fox jumps over the lazy dog and runs into the deep green forest"
    rows = [(1, None), (2, ""), (3, prose), (3, prose), (None, prose), (4, prose.upper()), (None, "word"), (5, "x " * 300_000), (6, "one two")]
    docs = spark.createDataFrame([(i, t, None, None, None, "l", 1, "f") for i, t in rows], DOCS)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=repr)
    assert got == sorted(((i, f"{plain_fingerprint(t):016x}", {None: 3 if t == prose else None, 1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6}[i]) for i, t in rows), key=repr)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


# ---- Merkle manifest -----------------------------------------------------------------

def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def fold_tree(nodes):
    """The top of a list of nodes and each one's (left, right) siblings, from below."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = k - k % 8
            paths[i].append(("".join(nodes[run:k]), "".join(nodes[k + 1 : run + 8])))
        nodes = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
        at = [k // 8 for k in at]
    return nodes[0], paths


def brute_manifest(rows):
    def leaf(r, text):
        parts = [r.doc_id, r.source, r.lang, r.n_chars, text]
        return sha("".join("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts))

    groups = defaultdict(list)
    for r in rows:
        groups[r.lang].append((r, leaf(r, r.text)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0].doc_id is not None, x[0].doc_id or 0, x[1]))
        subs[g] = fold_tree([h for _, h in groups[g]])
    root, above = fold_tree([subs[g][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for (r, h), path in zip(groups[g], subs[g][1]):
            path = path + above[k]
            node = h
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.text is not None:
                node = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text))
            for a, b in path:
                node = sha(a + node + b)
            out.append((r.doc_id, h, subs[g][0], root, sha("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=repr)


def manifest_query(monkeypatch, spark, docs):
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    return sorted(map(tuple, queries.QUERIES["op13_merkle"](spark, "").collect()), key=repr)


def test_manifest_of_the_given_table(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").collect()
    got = sorted(map(tuple, queries.QUERIES["op13_merkle"](spark, sf_dir).collect()), key=repr)
    assert got == brute_manifest(rows) and {v for *_, v in got} == {True, False}


@pytest.mark.parametrize("counts", [(1,), (8,), (9, 1), (512, 513), (4097, 7, 520), (1030, 3, 64 * 9)])
def test_manifest_over_several_rounds(spark, monkeypatch, counts):
    data = [(k * 10_000 + i, f"Text {i}", f"l{k}" if k else None, None, i, "x", 0, "y") for k, n in enumerate(counts) for i in range(n)]
    docs = spark.createDataFrame(data, DOCS)
    assert manifest_query(monkeypatch, spark, docs) == brute_manifest(docs.collect())


def test_manifest_of_many_groups(spark, monkeypatch):
    data = [(i, None, f"{i}", "s", 1, "x", 0, "y") for i in range(700)]
    docs = spark.createDataFrame(data, DOCS)
    assert manifest_query(monkeypatch, spark, docs) == brute_manifest(docs.collect())


def test_manifest_edge_cases(spark, monkeypatch):
    rows = [(None, "Ab", "en", "s", 2), (None, None, None, None, None), (1, "ÉA" * 100_000, "é", "s", 3), (1, "ÉA", "é", "s", 3), (1, "ÉA", "é", "s", 3), (2, "", "", "", 0), (3, "x", "=", None, -1), (5, "Q", None, "t", 1)]
    docs = spark.createDataFrame([(*r, "x", 0, "y") for r in rows], DOCS)
    assert manifest_query(monkeypatch, spark, docs) == brute_manifest(docs.collect())
    assert manifest_query(monkeypatch, spark, docs.limit(0)) == []
    with_path = merkle.manifest(docs, ["text"], "lang", "doc_id", carry=["leaf", "fp"])
    assert with_path.columns == ["doc_id", "leaf", "fp", "leaf", "subroot", "root", "path"]
