"""Corpus operators against brute force, exact round trips and held-out accuracy, and their edge cases."""

from __future__ import annotations

import io
import json
import os
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from emporia.llm import chat, decontam, html_text, langid, line_dedup, minhash, mixing, quality, queries, token_counts, warc
from emporia.llm.common import words_of
from emporia.sources.tables import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, label string"
PROSE = "the quick brown fox jumps over the lazy dog and runs into the deep green forest of the north while it rains"


def make(spark, rows):
    rows = [(i, t, lang, s) for i, t, lang, s in rows]
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), "x", None) for i, t, lang, s in rows], DOCS)


EDGE = [(1, None, "en", "a"), (2, "", None, None), (3, "\n\n", "en", "a"), (4, PROSE, "en", "b"), (4, PROSE, "en", "b"), (5, "word " * 30000, "en", "b"), (None, PROSE, None, "a"), (6, "x" * 200000, "en", None)]


@pytest.fixture(scope="module")
def edge(spark):
    return make(spark, EDGE).cache()


@pytest.fixture(scope="module")
def none(spark):
    return make(spark, [])


def test_token_counts_equal_the_tokenizer(spark, edge, none, sf_dir):
    import sentencepiece

    path = queries.tokenizer_path()
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    odd = make(spark, [(10 + i, t, None, None) for i, t in enumerate(["a ", " a", "a  b ", " ", "\t", "<s> x </s>", "▁ a", "é́ 　b", "a\r\nb \r"])])
    for docs in (table(spark, sf_dir, "documents"), odd, edge):
        want = sorted((r.doc_id or -1, len(model.encode(r.text or "")), len((r.text or "").encode())) for r in docs.select("doc_id", "text").collect())
        got = token_counts.token_counts(docs, path).collect()
        assert sorted((r.doc_id or -1, r.n_tokens, r.n_bytes) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 4096) for r in got)
    assert token_counts.token_counts(none, path).count() == 0


def test_slices_of_long_texts_cut_at_pre_tokens(monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE_CHARS", 7)
    units = token_counts.PieceLengths(queries.tokenizer_path(), True)
    text = PROSE + "  two  spaces "
    assert len(list(units.pre_tokens(text))) > 3
    assert sum(sum(units.lengths(p)) for p in units.pre_tokens(text)) == len(units.model.encode(text))


def test_targets_reshare_the_excess():
    got = mixing.targets([("a", 10), ("b", 100), (None, 100)])
    assert got["a"] == 20 and sum(got.values()) == pytest.approx(315) and got["b"] == pytest.approx(295 * 2 / 3) and got[None] == pytest.approx(295 / 3)
    assert mixing.targets([]) == {} and mixing.targets([("a", 0)]) == {"a": 0}


def test_mix_meets_targets_and_reruns_agree(spark, edge, none, sf_dir):
    weights = mixing.label_weights(table(spark, sf_dir, "labels"))
    for docs in (table(spark, sf_dir, "documents"), edge):
        got = mixing.mixing_plan(docs, weights).collect()
        assert len(got) == docs.count()
        goal, taken = {}, Counter()
        for r in got:
            goal[r.source] = r.target
            taken[r.source] += r.taken
            assert 0 <= r.taken <= 2 * r.size
        assert all(abs(taken[s] - t) <= 1 for s, t in goal.items())
        assert sorted(map(str, got)) == sorted(map(str, mixing.mixing_plan(docs, weights).collect()))
    assert mixing.mixing_plan(none).count() == 0
    once = mixing.mix(edge)
    assert once.columns == [*edge.columns, "_size", "_target", "_taken"]
    again = mixing.mix(once)
    assert again.columns == once.columns and again.count() <= once.count()


def base_of(text):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_quality_counts_and_verdict(spark, edge, none, sf_dir):
    more = make(spark, [(20, "a b c d e\tx a b c d e\ry", "en", "a"), (21, "a b c d e a b c d e a b", None, "a"), (22, "% | <é> #\n% | <é> #\n \n ", "xx", "a")])
    for docs in (table(spark, sf_dir, "documents"), edge, more):
        want = sorted((r.doc_id or -1, *base_of(r.text)) for r in docs.select("doc_id", "text").collect())
        got = quality.assess(docs).collect()
        assert sorted((r._id or -1, r._n_words, r._word_chars, r._n_symbols, r._n_dup_lines, r._n_repeat_words, r._base_failed) for r in got) == want
        assert not any(r._kept and r._base_failed for r in got)
    assert quality.assess(none).count() == 0
    assert quality.keep_good(edge).columns == edge.columns


def test_quality_rejects_junk_and_keeps_clean_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    clean = [r.text for r in docs.where("lang = 'en' and length(text) > 1500").limit(3).collect()]
    junk = " ".join(w + "%%%" for w in clean[0].split())
    rows = docs.unionByName(make(spark, [(10**6, junk, "en", "z"), (10**6 + 1, clean[1] + " more words", None, "z")]).select(docs.columns))
    kept = {r._id: r._kept for r in quality.assess(rows).where(F.col("_id") >= 10**6).collect()}
    assert kept == {10**6: False, 10**6 + 1: True}


def test_line_dedup_keeps_the_largest_holder(spark, edge, none):
    line = "  This line is in Many documents  "
    docs = make(spark, [(1, f"{line}\nown one\n{line}", "en", "a"), (2, f"x\n{line.strip().lower()}", "en", "a"), (3, f"{line}\n{line}", "en", "a"), (None, line, "en", "a"), (7, "short", "en", "a")])
    got = {r.doc_id: r.text for r in line_dedup.without_repeated_lines(docs).collect()}
    assert got == {1: "own one", 2: "x", 3: f"{line}\n{line}", None: line, 7: "short"}
    assert line_dedup.without_repeated_lines(edge).count() == len(EDGE)
    assert line_dedup.without_repeated_lines(none).count() == 0


def test_line_dedup_equals_brute_force_where_keys_run_over_partitions(spark):
    import random

    rng = random.Random(6)
    hot = "a line that every third document of the corpus holds"
    pool = [hot] * 6 + [f"a shared line with the number {k} in it" for k in range(12)] + ["short"]
    texts = {i: "\n".join(rng.choice(pool) if rng.random() < 0.8 else f"an own line of document {i} {rng.random()}" for _ in range(rng.randrange(1, 9))) for i in range(300)}
    holders = {}
    for i, t in texts.items():
        for line in t.split("\n"):
            holders.setdefault(line, set()).add(i)
    gone = lambda line, i: len(line) >= 20 and len(holders[line]) >= 3 and max(holders[line]) != i
    want = {i: "\n".join(x for x in t.split("\n") if not gone(x, i)) for i, t in texts.items()}
    docs = make(spark, [(i, t, "en", "a") for i, t in texts.items()])
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in ("1", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            stream = line_dedup.sorted_stream(line_dedup.line_hashes(docs, 20))
            over = stream.groupBy("h1", "h2").agg(F.count_distinct("part").alias("n")).agg(F.max("n")).first()[0]
            assert over == 1 if n == "1" else over > 3
            assert line_dedup.edge_keys(stream).count() <= 2 * int(n)
            assert {r.doc_id: r.text for r in line_dedup.without_repeated_lines(docs).collect()} == want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def brute_components(texts):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    head = {i: i for i in sets}

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                head[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_minhash_components_equal_brute_force(spark, edge, none, sf_dir):
    random.seed(5)
    words = [f"w{k}" for k in range(400)]
    base, texts = random.choices(words, k=90), {}
    for i in range(60):  # near copies at all similarities around the limit
        t = list(base)
        for _ in range(random.randint(0, 9)):
            t[random.randrange(len(t))] = random.choice(words)
        texts[i] = " ".join(t)
    texts |= {100: texts[3].upper(), 101: "a b", 102: "a  B", 103: None, 104: ""}
    texts |= {1000 + r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    got = minhash.near_duplicates(make(spark, [(i, t, None, None) for i, t in texts.items()])).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts)
    assert minhash.near_duplicates(none).count() == 0
    assert len(minhash.near_duplicates(edge).collect()) == len(EDGE)


def test_near_copies_below_the_similarity_are_not_paired_with_all(spark, monkeypatch):
    rng = random.Random(11)
    words = [f"w{k}" for k in range(5000)]
    passage, texts = rng.choices(words, k=12), {}
    for family, copies in enumerate((300, 40)):
        base = rng.choices(words, k=130)
        for i in range(copies):  # 2 to 6 words changed: most links are with the least changed copies, many copies have none
            t = list(base)
            for place in rng.sample(range(len(t)), rng.randint(2, 6)):
                t[place] = rng.choice(words)
            texts[1000 * family + i] = " ".join(passage + t)
    texts |= {5000 + i: " ".join(passage + rng.choices(words, k=rng.randint(3, 30))) for i in range(40)}
    want, candidates, check = brute_components(texts), [], minhash.confirmed

    def confirmed(pairs, sets):
        candidates.append(pairs.count())
        return check(pairs, sets)

    monkeypatch.setattr(minhash, "confirmed", confirmed)
    docs = make(spark, [(i, t, None, None) for i, t in texts.items()])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()}
    assert got == want and len({c for _, c in want.values()}) > 100
    assert candidates[-1] <= 4 * len(texts)
    # the exact step alone, with one center a list and the rest by rare shingles
    monkeypatch.setattr(minhash, "CENTER_ROUNDS", 0)
    monkeypatch.setattr(minhash, "PIVOT_ROUNDS", 1)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()} == want


def test_minhash_rounds_do_no_work_twice(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(2000)]
    base, texts = rng.choices(words, k=100), {}
    for i in range(60):  # many copies have no link, so the last step finds none
        t = list(base)
        for place in rng.sample(range(100), rng.randint(1, 6)):
            t[place] = rng.choice(words)
        texts[i] = " ".join(t)
    names, empty, relabel, write = [], [], minhash._relabelled, minhash.staged

    def relabelled(labels, edges):
        empty.append(labels is not None and edges.isEmpty())
        return relabel(labels, edges)

    def staged(df, name):
        names.append(name)
        return write(df, name)

    monkeypatch.setattr(minhash, "_relabelled", relabelled)
    monkeypatch.setattr(minhash, "staged", staged)
    got = minhash.near_duplicates(make(spark, [(i, t, None, None) for i, t in texts.items()])).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts)
    assert names.count("edges") > len(empty) and not any(empty)  # components are not made anew without a link
    assert names.count("common-centers") == names.count("centers") > 0  # the centers of a round are made once


def test_minhash_links_through_all_texts_of_a_document(spark):
    one, other = PROSE, "an entirely different text about ships that sail over the wide sea at night with no wind at all"
    third = " ".join(f"word{i}" for i in range(40))
    rows = [(1, one), (1, other), (1, other), (2, one + " more"), (3, other), (4, None), (4, other + " too"), (5, third), (6, ""), (7, third + " end"), (7, third + " end"), (None, one)]
    got = minhash.near_duplicates(make(spark, [(i, t, None, None) for i, t in rows])).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 6, 7: 5, None: None}
    assert all(r.kept == (r.doc_id in (None, r.component_id)) for r in got)
    got = minhash.near_duplicates(make(spark, [(i, t, None, None) for i, t in [(1, one), (5, one), (5, third), (6, third + " end")]])).collect()
    assert {r.component_id for r in got} == {1} and len(got) == 4


def test_shingle_hashes_do_not_depend_on_the_process():
    import subprocess
    import sys

    code = "from emporia.llm.minhash import shingle_hashes as s; print(s('one two three four five six').tolist())"
    runs = {subprocess.run([sys.executable, "-c", code], env={**os.environ, "PYTHONHASHSEED": seed}, capture_output=True, text=True, check=True).stdout for seed in ("0", "7")}
    assert len(runs) == 1 and "[" in runs.pop()


def test_leaks_are_found_and_clean_documents_left_alone(spark, none, sf_dir):
    bench = table(spark, sf_dir, "benchmark")
    item = max(bench.collect(), key=lambda r: len(r.text))
    w = item.text.split()
    near = [*w[:10], "changed", *w[11:]]
    docs = make(spark, [(1, "before it " + item.text.upper() + " after", "en", "a"), (2, "x " + " ".join(near), "en", "a"), (3, " ".join(w[: len(w) // 2]), "en", "a"), (4, None, "en", "a"), (5, PROSE, "en", "a"), (6, "\n".join(w), None, None)])
    got = {r.doc_id: r for r in decontam.leaks(docs, bench).where(F.col("item_id") == item.item_id).collect()}
    assert set(got) == {1, 2, 6} and got[1].similarity == 1 and got[1].start == 2
    index = decontam.ItemIndex([(item.item_id, item.text)])
    near_counts = Counter(decontam.shingles([x.lower().encode() for x in near], 5))
    assert got[2].similarity == pytest.approx(index.similarity(0, near_counts)) and got[2].similarity >= 0.75
    assert {r.doc_id for r in decontam.without_leaks(docs, bench).collect()} == {3, 4, 5}
    assert decontam.leaks(none, bench).count() == 0 and decontam.leaks(docs, bench.limit(0)).count() == 0
    assert [m[0] for m in decontam.ItemIndex([(9, "two words")]).matches("here two words stand")] == [9]


def test_short_junk_is_judged_and_short_clean_text_kept(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    junk = "Thingor%%% that*** of.&&& Onerea$$$ erored$$$ thoring%%% tionnd.%%%\nThe and attion to than the erea%%% on***"
    mail = "With lecne.06@mail4.example.com +1 (807) 555-5623 stupid ateant anes and, clown with the other of them"
    short = spark.createDataFrame([(10**6, junk, "en", "a"), (10**6 + 1, mail, "en", "a"), (10**6 + 2, "the and of that with " * 2 + "more", "en", "a")], "doc_id long, text string, lang string, source string")
    got = {r._id: (r._n_words, r._kept) for r in quality.assess(docs.union(short)).where(F.col("_id") >= 10**6).collect()}
    assert all(10 <= n < quality.MIN_WORDS_CHARS for n, _ in got.values())
    assert not got[10**6][1] and got[10**6 + 1][1]


@pytest.mark.parametrize("holders", [1, 2, 3, 10])
def test_near_copies_of_shared_items_are_found(spark, holders):
    w = [f"w{holders}x{i}" for i in range(39)]
    edge, half = [*w[:36], "changed", *w[37:]], [*w[:20], *[f"other{i}" for i in range(19)]]
    repeated = spark.createDataFrame([(i, " ".join(w)) for i in range(holders)], "item_id long, text string")
    docs = make(spark, [(1, " ".join(["x", *edge, "y"]), "en", "a"), (2, " ".join(half), "en", "a")])
    got = decontam.leaks(docs, repeated).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, i) for i in range(holders)]
    assert all(r.similarity == pytest.approx(32 / 38) for r in got)
    template = decontam.ItemIndex([(i, " ".join([*w, *[f"own{i}x{k}" for k in range(4)]])) for i in range(holders)])
    near = " ".join([*w[:2], "changed", *w[3:], *[f"own0x{k}" for k in range(4)]])
    assert 0 in [m[0] for m in template.matches(near)]


def test_blocks_of_items_do_not_change_the_leaks(spark, sf_dir, monkeypatch):
    bench = [r.text for r in table(spark, sf_dir, "benchmark").orderBy("item_id").limit(6).collect()]
    stem = " ".join(f"stem{i}" for i in range(30))
    bench += [f"{stem} " + " ".join(f"own{k}x{i}" for i in range(12)) for k in range(7)] + ["two words"] * 4
    items = spark.createDataFrame(list(enumerate(bench)), "item_id long, text string")
    texts = [t.replace(f"stem{i} ", "changed ") for t in bench for i in (3, 15)] + [" ".join(t.split()[8:]) for t in bench]
    texts += [" ".join([bench[6 + k], *bench[7 + k].split()[i:]]) for k in range(6) for i in (0, 20, 28, 34)]
    docs = make(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    rows = lambda: sorted(map(tuple, decontam.leaks(docs, items).collect()))
    whole = rows()
    assert len(whole) > 50
    for size in (1000, 1):
        monkeypatch.setattr(decontam, "BLOCK_CHARS", size)
        assert rows() == whole


def test_leaks_without_ids_and_under_one_id(spark):
    item, unnamed = (" ".join(f"{w}{i}" for i in range(30)) for w in ("named", "unnamed"))
    bench = spark.createDataFrame([(1, item), (None, unnamed)], "item_id long, text string")
    rows = [(None, item, "en", "a"), (None, PROSE, "en", "a"), (7, item, "en", "a"), (7, PROSE, "en", "a"), (7, None, "en", "a"), (8, "x " + unnamed, "en", "a")]
    docs = make(spark, rows)
    got = sorted(((r.doc_id, r.item_id) for r in decontam.leaks(docs, bench).collect()), key=str)
    assert got == [(7, 1), (8, None), (None, 1)]
    kept = decontam.without_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == [(7, PROSE), (7, None), (None, PROSE)]


def test_one_word_edits_far_apart_in_bits_are_found():
    import random

    rng, far = random.Random(5), []
    seen = lambda w: decontam._packed(decontam._spread(decontam._hashes(decontam.shingles(w, 5))).sum(axis=0))
    for _ in range(3000):
        w = [str(rng.randrange(10**9)) for _ in range(39)]
        near = [*w[:20], "changed", *w[21:]]
        if 19 < decontam._ONES[seen([x.encode() for x in w]) ^ seen([x.encode() for x in near])].sum() <= 23:
            far.append((" ".join(w), " ".join(near)))
    assert far
    index = decontam.ItemIndex([(i, text) for i, (text, _) in enumerate(far)])
    assert [[m[0] for m in index.matches(near)] for _, near in far] == [[i] for i in range(len(far))]


def test_multi_index_finds_all_within_the_radius():
    import numpy as np

    rng = np.random.default_rng(1)
    index = decontam.ItemIndex([(i, f"word{i} " * (3 + i % 3) + "and some more words to follow") for i in range(50)])
    for _ in range(200):
        own = rng.integers(50)
        probe = index.prints[own].copy()
        for bit in rng.choice(64, rng.integers(0, 24), replace=False):
            probe[bit // 16] ^= np.uint16(1 << (bit % 16))
        ones = [sum(bin(int(x)).count("1") for x in row ^ probe) for row in index.prints]
        for length in (9, 10, 11):
            want = [k for k, n in enumerate(ones) if n <= decontam.RADIUS and index.lengths[index.owner[k]] == length]
            assert sorted(index.candidates(probe, length).tolist()) == want
    assert index.candidates(index.prints[7], index.lengths[7]).size


def test_matches_equal_every_window_by_brute_force():
    import random

    rng = random.Random(4)
    items = [[f"w{rng.randrange(400)}" for _ in range(n)] for n in (12, 12, 30, 45, 45, 7, 3)] + [["w1"] * 20]
    index = decontam.ItemIndex([(i, " ".join(w)) for i, w in enumerate(items)])
    seen = 0
    for _ in range(60):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(0, 60))]
        for item in rng.choices(items, k=3):
            part = item[rng.randrange(3):]
            if rng.random() < 0.5:
                part = [*part[:5], "changed", *part[6:]]
            words += part * rng.randrange(1, 3) + ["between"]
        coded, best = [w.encode() for w in words], {}
        for i, item in enumerate(items):
            wide, size = min(len(item), len(words)), index.sizes[i]
            for start in range(len(words) - wide + 1):
                similarity = index.similarity(i, Counter(decontam.shingles(coded[start : start + wide], size)))
                if similarity >= 0.75 and similarity > best.get(i, (0,))[0]:
                    best[i] = (similarity, start, wide)
        assert list(index.matches(" ".join(words))) == [(i, *best[i]) for i in sorted(best)]
        seen += len(best)
    assert seen > 60


def test_leaks_read_the_documents_once_for_many_items_of_any_id_type(spark):
    bench = spark.range(5000).selectExpr("concat('item-', id) item_id", "concat_ws(' ', transform(sequence(1, 30), k -> concat('b', id, 'x', k))) text")
    docs = make(spark, [(1, "before " + " ".join(f"b4321x{k}" for k in range(1, 31)), "en", "a"), (2, PROSE, "en", "a"), (3, "long " * 300000, "en", "a")])
    found = decontam.leaks(docs, bench)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert [(r.doc_id, r.item_id, r.similarity, r.start) for r in found.collect()] == [(1, "item-4321", 1.0, 1)]


def test_warc_round_trip_and_salvage(spark, tmp_path):
    long = "<p>" + "text " * 400 + "</p>"
    pages = spark.createDataFrame([(1, "http://a/", long), (2, "http://b c/\n", long), (5, None, long), (3, "u", "short"), (4, "u", "short"), (6, "u", None), (None, "u", long)], "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.page_rows(warc.archive_and_read(pages)).collect()}
    assert len(got) == 7 and got[5].record_type == "response" and {got[k].refers_to for k in (1, 2, None)} == {5}
    assert got[1].payload_bytes == len(long) and got[1].payload_digest == got[5].payload_digest and got[6].payload_bytes == 0
    assert got[3].record_type == got[4].record_type == "response"

    members = [warc._member(warc.page_record(i, f"http://x/{i}", (long + str(i)).encode(), None)) for i in range(6)]
    damaged = bytearray(members[2])
    damaged[len(damaged) // 2] ^= 0xFF
    plain = warc.page_record(8, "http://p", b"plain", None)
    data = members[0] + members[1] + bytes(damaged) + b"garbage" + members[3] + plain + members[4] + members[5][:-20]
    path = tmp_path / "x.warc.gz"
    path.write_bytes(data)
    rows = warc.read_archives(spark.createDataFrame([(str(path),)], "path string"), str(tmp_path)).orderBy("offset").collect()
    assert [r.record_id for r in rows if r.kind == "record"] == [f"urn:page:{i}" for i in (0, 1, 3, 8, 4)]
    gaps = [(r.offset, r.length) for r in rows if r.kind == "gap"]
    assert gaps == [(len(members[0] + members[1]), len(damaged) + 7), (len(data) - len(members[5]) + 20, len(members[5]) - 20)]
    assert warc.page_rows(warc.archive_and_read(pages.limit(0))).count() == 0


def salvaged(data):
    class File(io.BytesIO):
        def size(self):
            return len(self.getbuffer())

    return [(r["kind"], r["offset"], r["length"], r.get("inner"), r.get("record_id")) for r in warc.Archive(File(bytes(data))).salvage()]


def test_salvage_inside_a_member():
    records = [warc.page_record(i, f"http://x/{i}", f"text {i} ".encode() * 4000, None) for i in range(3)]
    n = len(records[0])
    damaged = bytearray(records[1])
    damaged[n // 2] ^= 1
    first, last = ("record", 0, n, 0, "urn:page:0"), ("record", 0, n, 2 * n, "urn:page:2")
    assert salvaged(warc._member(records[0] + bytes(damaged) + records[2])) == [first, ("gap", 0, n, n, None), last]
    # no version line at the front of the member
    assert salvaged(warc._member(b"x" * n + records[1] + records[2])) == [("gap", 0, n, 0, None), ("record", 0, n, n, "urn:page:1"), last]

    rng = random.Random(1)
    noisy = [warc.page_record(i, f"http://x/{i}", rng.randbytes(300_000), None) for i in range(3)]
    cut = warc._member(b"".join(noisy))[:-100_000]
    found = salvaged(cut + warc._member(records[0]))
    assert [r[4] for r in found if r[0] == "record"] == ["urn:page:0", "urn:page:1", "urn:page:0"]
    assert [r[1:3] for r in found if r[0] == "gap"] == [(0, len(cut))]
    flipped = bytearray(warc._member(b"".join(noisy)))
    flipped[450_000] ^= 1
    assert [r[4] for r in salvaged(flipped) if r[0] == "record"][:1] == ["urn:page:0"]


def test_salvage_of_records_without_digests_and_odd_headers():
    bare = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    member = bytearray(warc._member(bare))
    assert [r[0] for r in salvaged(member)] == ["record"]
    member[-6] ^= 1
    assert [r[0] for r in salvaged(member)] == ["gap"]
    long = bare.replace(b"Content-Length", b"X: " + b"y" * 600_000 + b"\r\nContent-Length")
    assert salvaged(long) == [("record", 0, len(long), None, None)]
    wrong = b"WARC/1.0\r\nContent-Length: 99999999999\r\n\r\n"
    assert salvaged(wrong + bare) == [("gap", 0, len(wrong), None, None), ("record", len(wrong), len(bare), None, None)]
    assert salvaged(warc._member(wrong + bare)) == [("gap", 0, len(wrong), 0, None), ("record", 0, len(bare), len(wrong), None)]
    assert salvaged(b"") == [] and [r[0] for r in salvaged(b"x")] == ["gap"]


def test_pieces_of_any_size_give_the_same_records(monkeypatch):
    records = [warc.page_record(i, None, f"text {i} ".encode() * 50, None) for i in range(4)]
    data = warc._member(records[0] + records[1][:-9] + records[2]) + b"?" + records[3] + warc._member(b"") + warc._member(records[1])[:-4]
    want = salvaged(data)
    assert [r[4] for r in want if r[0] == "record"] == ["urn:page:0", "urn:page:2", "urn:page:3", "urn:page:1"]
    for chunk in (11, 64, 1000):
        monkeypatch.setattr(warc, "CHUNK", chunk)
        assert salvaged(data) == want


def test_language_accuracy_spans_and_edges(spark, edge, none, sf_dir):
    docs = table(spark, sf_dir.replace("sf0.001", "sf0.01"), "documents")
    got = queries.language_query(spark, sf_dir.replace("sf0.001", "sf0.01")).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang_pred == r.lang for r in got) >= 0.97 * len(got) and all(0 <= r.score <= 1 for r in got)
    model = langid.learn(docs)
    some = {r.lang: r.t for r in docs.where("length(text) > 900").groupBy("lang").agg(F.min(F.substring("text", 1, 400)).alias("t")).collect()}
    found = [x for _, _, x in langid.spans(model, some["de"] + " " + some["es"])]
    assert found[0] == "de" and found[-1] == "es" and len(found) <= 4
    labels = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(edge, model).collect()}
    assert labels[1] == labels[2] == labels[3] == ("und", 0.0)
    assert langid.predict_texts(langid.Model([], __import__("numpy").zeros((0, langid.GRAM_BUCKETS)), __import__("numpy").zeros((0, langid.N_SCRIPTS))), ["abc", None]) == [("und", 0.0)] * 2
    assert langid.predict(none, model).count() == 0


def test_long_texts_in_slices_have_a_best_path_of_the_whole(spark, sf_dir, monkeypatch):
    import random

    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs)
    by_lang = {}
    for r in docs.where("lang is not null and length(text) > 200").collect():
        by_lang.setdefault(r.lang, []).append(r.text)
    rng = random.Random(2)
    texts = ["\n".join(t[: rng.randrange(20, 900)] for t in rng.choices([t for ts in by_lang.values() for t in ts], k=12)) for _ in range(6)]
    texts += [None, "", "12 34 " * 5000, "x" * 20000, " ".join(by_lang["de"][:3])]

    def value(text, spans):
        words = langid.Words([text])
        lang = {a: x for a, _, x in spans}
        path, now = [], None
        for at in words.at.tolist():
            now = lang.get(at, now)
            path.append(model.languages.index(now))
        scores = model.scores(words)
        return sum(scores[k, p] for k, p in enumerate(path)) - langid.SWITCH_PENALTY * sum(a != b for a, b in zip(path, path[1:]))

    whole = langid.label_texts(model, texts)
    monkeypatch.setattr(langid, "TEXT_CELLS", 0)
    monkeypatch.setattr(langid, "BLOCK_WORDS", 7)
    sliced = langid.label_texts(model, texts)
    assert max(len(t or "") for t in texts[:6]) > 4096 and sum(len(s) > 2 for _, _, s in whole) >= 3
    for text, a, b in zip(texts, whole, sliced):
        assert a[0] == b[0]
        if text and not text.startswith("xx"):
            assert a[1] == pytest.approx(b[1], abs=0.01) and value(text, a[2]) == pytest.approx(value(text, b[2]), abs=0.1)
    assert "".join(langid._slices("x" * 10000 + " y", 4096)) == "x" * 10000 + " y"


def test_word_scores_equal_brute_force(spark, sf_dir):
    import math

    model = langid.learn(table(spark, sf_dir, "documents"))
    words = langid.Words(["Two words", None, "mot\u0436 a"])
    assert words.text.tolist() == [0, 0, 2, 2] and words.at.tolist() == [0, 4, 0, 5] and words.lengths.tolist() == [3, 5, 4, 1]

    def gram(points):
        h = 0
        for p in points:
            h = ((h ^ p) * 0x9E3779B97F4A7C15) % 2**64
            h ^= h >> 32
        return h % langid.GRAM_BUCKETS

    for k, word in enumerate(["two", "words", "mot\u0436", "a"]):
        points = [32] * (langid.GRAM - 1) + [ord(c) for c in word] + [32]
        grams = [gram(points[i : i + langid.GRAM][::-1]) for i in range(len(word) + 1)]
        grams[-1] = gram([32, *points[-langid.GRAM : -1][::-1]])
        bars = model.bars[langid.script_table()[ord(word[0])]]
        want = model.logs[grams].sum(axis=0) + bars
        assert model.scores(words)[k].tolist() == pytest.approx(want.tolist(), rel=1e-4) and not math.isnan(want[0])


def test_best_path_equals_brute_force():
    import itertools

    import numpy as np

    rng = np.random.default_rng(3)
    scores = rng.normal(size=(4, 5, 3)).astype(np.float32)
    lengths = np.array([5, 3, 1, 4])
    got = langid.best_paths(scores, lengths, 1.0)
    for k, n in enumerate(lengths):
        value = lambda p: sum(scores[k, t, s] for t, s in enumerate(p)) - sum(a != b for a, b in zip(p, p[1:]))
        assert value(got[k, :n]) == pytest.approx(max(value(p) for p in itertools.product(range(3), repeat=int(n))))


def test_chat_links_orders_and_validates(spark):
    call = json.dumps({"content": "let me see", "tool_calls": [{"id": "c1", "name": "search", "arguments": {"query": "x", "limit": "no"}}, {"id": "c2", "function": {"name": "other", "arguments": "{\"b\": 1, \"a\": [2, 1]}"}}]})
    rows = [(1, 0, "user", "hi"), (1, 3, "assistant", call), (1, 2, "tool", json.dumps({"tool_call_id": "c1", "content": "found"})), (1, 5, "tool", json.dumps({"tool_call_id": "c9", "content": "lost"})), (1, 6, "assistant", None), (2, 0, "user", "{not json"), (None, None, None, None)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, message string")
    got = {(r.conv_id, r.turn): r for r in chat.format_chats(frame).collect()}
    assert len(got) == len(rows)
    assert (got[1, 2].place_turn, got[1, 2].place_depth) == (3, 1) and (got[1, 5].place_turn, got[1, 5].place_depth) == (5, 0)
    assert got[1, 5].errors == "no call c9" and got[1, 3].errors == "c1: type of limit; c2: unknown tool other" and got[1, 3].n_calls == 2
    assert '"arguments":{"a":[2,1],"b":1}' in got[1, 3].message and json.loads(got[1, 2].message)["tool_call_id"] == "c1"
    assert json.loads(got[2, 0].message) == {"content": "{not json", "conv_id": 2, "role": "user", "turn": 0} and json.loads(got[1, 6].message)["content"] is None
    cycle = [(1, 0, "assistant", json.dumps({"tool_calls": [{"id": "a", "name": "fetch", "arguments": {"url": "u"}}], "depends_on": ["a"]})), (1, 1, "tool", json.dumps({"tool_call_id": "a", "content": "r"}))]
    assert {r.errors for r in chat.format_chats(spark.createDataFrame(cycle, "conv_id long, turn long, role string, text string")).collect()} == {"cycle"}
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_chat_keeps_every_field_and_reports_the_rest(spark):
    call = {"content": {"parts": [1, "x"]}, "role": "assistant", "turn": 9, "depends_on": "c0", "model": "m", "tool_calls": [
        {"id": "c1", "type": "function", "function": {"name": "search", "arguments": {"query": "x"}, "strict": True}}, "stray", {"id": "c2", "name": "search", "arguments": "no json"}]}
    answer = {"tool_call_id": "c1", "content": {"b": 1, "a": None}, "is_error": False}
    rows = [(1, 0, "assistant", json.dumps(call)), (1, 1, "tool", json.dumps(answer)), (1, 1, "tool", json.dumps(answer)), (1, 2, "assistant", json.dumps({"tool_calls": {"id": "c3"}})), (1, 3, "tool", json.dumps({"tool_call_id": "c2", "content": "long " * 400000}))]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("turn").collect()
    assert len(got) == 5 and got[1] == got[2]
    first = {"content": call["content"], "conv_id": 1, "depends_on": "c0", "model": "m", "role": "assistant", "tool_calls": [
        {"arguments": {"query": "x"}, "function": {"strict": True}, "id": "c1", "name": "search", "type": "function"}, "stray", {"arguments": "no json", "id": "c2", "name": "search"}], "turn": 0}
    assert got[0].message == json.dumps(first, separators=(",", ":"), sort_keys=True)
    assert got[0].n_calls == 2 and got[0].errors == "depends_on is no list; turn differs; entry 1 is no call; c2: arguments are no object"
    assert got[1].message == json.dumps({**answer, "conv_id": 1, "role": "tool", "turn": 1}, separators=(",", ":"), sort_keys=True) and got[1].errors == ""
    assert got[3].errors == "tool_calls is no list" and json.loads(got[3].message)["content"] == rows[3][3] and got[3].n_calls == 0
    assert json.loads(got[4].message)["content"] == "long " * 400000


def test_chat_places_equal_brute_force(spark, monkeypatch):
    import random

    rng, edges = random.Random(9), {(99, t, t + 1) for t in range(999)}  # a chain that is written backwards
    for conv in range(12):
        edges |= {(conv, rng.randrange(14), rng.randrange(14)) for _ in range(rng.randrange(1, 14))}
    edges |= {(50, t, t - 1) for t in range(1, 9)}

    def brute(conv):
        needs = {}
        for c, t, n in edges:
            if c == conv:
                needs.setdefault(t, set()).add(n)
                needs.setdefault(n, set())
        places = {}
        while ready := [t for t in needs if t not in places and needs[t] <= places.keys()]:
            for t in ready:
                places[t] = max([(t, 0), *((places[n][0], places[n][1] + 1) for n in needs[t])])
        return {(conv, t): places.get(t) for t in needs}

    writes, staged = [], chat.staged
    monkeypatch.setattr(chat, "staged", lambda df, name: writes.append(name) or staged(df, name))
    found = chat._places(spark.createDataFrame(sorted(edges), "conv_id long, turn long, need long")).collect()
    want = {k: v for conv in {c for c, _, _ in edges} for k, v in brute(conv).items()}
    assert {(r.conv_id, r.turn): r.place and tuple(r.place) for r in found} == want and None in want.values()
    assert writes.count("needs") <= 12


def test_html_layout():
    page = "<html><head><title>T</title><style>p{}</style></head><body><h1>Head</h1><p>One <b>two</b><p>Three &amp; four<ul><li>a<li>b<ol><li>c</ol></ul><table><tr><th>Name<th>N<tr><td>x<td>10</table><div hidden>no</div><span style='display: none'>no</span><pre>a\n  b</pre>end<!-- no --><script>no</script>"
    want = "Head\n\nOne two\n\nThree & four\n\n* a\n* b\n\n  1. c\n\nName  N\nx     10\n\na\n  b\n\nend"
    assert html_text.page_text(page) == want
    assert html_text.page_text(None) == "" and html_text.page_text("<p") == "" and html_text.page_text("a < b <b 'x>y") == "a < b y"
    assert "deep" in html_text.page_text("<div>" * 5000 + "deep")


SHOWN_AND_HIDDEN = {
    "<textarea>a &amp; b\nc</textarea>x": "a & b\nc\nx",
    "<select><option>one<option selected>two</select> end": "two end",
    "<select multiple><optgroup label=G><option>one<option>two</select>": "G\none\ntwo",
    "<svg><title>no</title><text>Draw</text><text>ing</text><defs><text>no</text></defs></svg>": "Draw ing",
    "<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math>": "x=1",
    "<div style='visibility:hidden'>no<span style='visibility: visible'>yes</span></div>": "yes",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>": "a  b\n   c\nd  e",
    "<table><tr><td colspan=3>wide<td>z<tr><td>1<td>2<td>3<td>4</table>": "wide     z\n1  2  3  4",
    "<table><tr style='visibility:collapse'><td>no<tr><td>yes</table>": "yes",
    "<div>" * 300 + "<script>no</script><p>yes</p><div hidden>no<b>no</b></div><template>no</template>also<style>no</style>" + "</div>" * 300 + "after": "yes\nalso\nafter",
}


@pytest.mark.parametrize("page", SHOWN_AND_HIDDEN)
def test_html_shows_all_visible_text_and_nothing_else(page):
    assert html_text.page_text(page) == SHOWN_AND_HIDDEN[page]


def test_html_texts_stay_in_proportion():
    wide = "<table><tr><td>" + "w" * 20000 + "<tr><td>a<td>b" * 2000 + "</table>"
    assert len(html_text.page_text(wide)) < 5 * len(wide)
    spans = "<table>" + "<tr><td colspan=1000 rowspan=1000>a<td>b" * 500 + "</table>"
    assert html_text.page_text(spans).split() == ["a", "b"] * 500
    assert len(html_text.page_text("<div><p>a" * 20000).split()) == 20000


def visible_characters(page):
    """The characters, without white space, outside head, scripts, styles, templates, comments and hidden elements, by another parser."""
    from html.parser import HTMLParser

    out, void = [], set("area base br col embed hr img input link meta source track wbr".split())

    class Words(HTMLParser):
        stack = []

        def handle_starttag(self, tag, attrs):
            a = dict(attrs)
            if tag not in void:
                hidden = tag in ("head", "title", "script", "style", "template", "noscript") or "hidden" in a or "display:none" in (a.get("style") or "").replace(" ", "")
                self.stack.append((tag, hidden))
            elif tag == "img" and not any(h for _, h in self.stack):
                out.extend((a.get("alt") or "").split())

        def handle_endtag(self, tag):
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] == tag:
                    del self.stack[i:]
                    break

        def handle_data(self, data):
            if not any(h for _, h in self.stack):
                out.extend(data.split())

    parser = Words()
    parser.stack = []
    parser.feed(page or "")
    parser.close()
    return Counter("".join(out))


def test_extract_over_the_given_pages_and_edges(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    texts = {r.page_id: r for r in html_text.extract(pages).collect()}
    rows = pages.select("page_id", "html").collect()
    assert len(texts) == len(rows)
    drawn = Counter()
    for r in rows:
        missing = visible_characters(r.html) - Counter("".join(texts[r.page_id].text.split()))
        drawn.update(missing)
    assert not drawn
    odd = [(1, None, "u", "x"), (2, "", "u", "x"), (3, "<p>a" * 50000, "u", "x"), (3, "<p>a" * 50000, "u", "x"), (None, "<b>t</b>", "u", "x")]
    frame = spark.createDataFrame(odd, "page_id long, html string, text string, n_chars string")
    got = html_text.extract(frame).collect()
    assert sorted((r.page_id or 0, r.n_lines, len(r.text)) for r in got) == [(0, 1, 1), (1, 0, 0), (2, 0, 0), (3, 99999, 149998), (3, 99999, 149998)]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_words_are_split_alike_by_both_ways(spark):
    texts = ["a b\nc", " a  b ", "a\tb\x0bc\x0cd\re", "", None, "x y z", "\n"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(words_of(F.col("t")).alias("w")).collect()
    assert [r.w for r in got] == [["a", "b", "c"], ["a", "b"], ["a", "b", "c", "d", "e"], [], [], ["x y", "z"], []]


def test_pipeline_runs_and_keeps_columns(spark, sf_dir):
    import corpus_pipeline

    docs = make(spark, [(1000, None, None, None), (1001, "", "en", "a")]).select("doc_id", "text", "lang", "source", "n_chars").union(table(spark, sf_dir, "documents"))
    for name, stage in corpus_pipeline.STAGES:
        columns, rows, docs = docs.columns, docs.count(), stage(spark, docs, sf_dir).checkpoint()
        assert docs.count() <= rows and (docs.columns == columns or name == "source_mixing"), name
    assert docs.count() > 50
