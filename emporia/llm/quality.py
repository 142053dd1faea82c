"""Quality rules: base counts and distribution divergence from language references.

Every document gets two histograms: its characters by class (letters and
digits, punctuation, symbols, word breaks) and its words over the most common
words of a language (one bin each, and one for all other words).  A
language's reference holds the medians of the same shares over all documents
of that language, so that junk below half of them doesn't bend it; its common
words are those found in most documents.  A document diverges when the
Jensen-Shannon distance (base 2, 0 to 1) of a histogram is above its limit
for every reference.  Below ``MIN_WORDS_CHARS`` words the characters' limit
widens with the square root of the length, as a short text's histogram is more
chance; below ``MIN_WORDS_WORDS`` a document isn't judged by common words.

Everything is DataFrame expressions; a document's histograms are made in its
own row and judged without its text.  What the driver holds is one reference a
language.

Cases: a null or empty text has no words and fails the base rules; null
languages make no reference and are compared with all; a table without
languages is judged by the base rules alone; repeated rows are judged alike;
very long texts stay in their row; an empty table gives an empty result;
columns of any other names are returned as they were.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import WHITESPACE, let, packed, staged, words_of

LEAST_WORDS = 10
MOST_REPEAT_PCT = 20
WINDOW = 5
COMMON_WORDS = 12         # bins of a language's word histogram, besides all other words
TRACKED_WORDS = 10_000    # counters of the heavy-hitter sketch that finds them
MEDIAN_ACCURACY = 10_000
MIN_WORDS_CHARS = 20      # shorter documents are judged by characters with a wider limit
MIN_WORDS_WORDS = 200     # shorter documents aren't judged by common words
MAX_CHAR_DISTANCE = 0.16
MAX_WORD_DISTANCE = 0.26

FEW_COMMON = 0.05         # below this share of common words, all languages are tried

LATIN = r"[a-zA-Z0-9À-ÖØ-öø-ɏ]+"
SYMBOLS = r"[#*$%&|<>]+"
PUNCTUATION = r"[\p{Pd}\p{Ps}\p{Pe}\p{Pi}\p{Pf}.,;:!?'\"¡¿…]+"


def _without(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(""))


def char_shares(n_chars: Column, rest: Column, n_words: Column) -> Column:
    """Shares of [letters and digits, punctuation, symbols and others, word breaks].

    ``n_chars``: characters in words; ``rest``: those that are neither Latin letters nor ASCII digits.
    """
    counts = lambda a: let(_without(a, PUNCTUATION), lambda b: F.array(n_chars - F.char_length(a), F.char_length(a) - F.char_length(b), F.char_length(b), n_words))
    return let(_without(rest, r"[\p{L}\p{M}\p{N}]+"), lambda a: let(counts(a).cast("array<double>"), _normed))


def repeat_words(words: Column, size: int = WINDOW) -> Column:
    """Words that lie in a window of ``size`` words found twice or more in the text.

    Windows are compared by a 64-bit hash; only texts with a repeated window sort them.
    """
    each = F.transform(words, lambda w: F.xxhash64(w))
    hashes = let(each, lambda h: F.slice(F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, size)])), 1, F.size(h) - (size - 1)))

    def covered(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda p, k: F.least(F.lit(size), F.coalesce(F.get(at, k + 1) - p, F.lit(size)))), F.lit(0), lambda a, x: a + x)

    def of_sorted(s: Column) -> Column:
        twice = F.filter(s, lambda e, k: F.coalesce(e.h == F.get(s, k - 1).h, F.lit(False)) | F.coalesce(e.h == F.get(s, k + 1).h, F.lit(False)))
        return let(F.sort_array(F.transform(twice, lambda e: e.i)), covered)

    def of_hashes(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(F.sort_array(pairs), of_sorted)).otherwise(0)

    return F.when(F.size(words) > size, let(hashes, of_hashes)).otherwise(0).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.trim(x, F.lit(WHITESPACE))) > 0)
    return F.coalesce(let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))), F.lit(0)).cast("long")


def base_counts(rows: DataFrame) -> DataFrame:
    """``rows`` (_text) with _words, _rest, the five base counts and the base verdict."""
    rows = rows.withColumn("_words", words_of(F.col("_text")))
    rows = rows.withColumn("_solid", F.array_join("_words", ""))
    rows = rows.select(
        "*", F.size("_words").cast("long").alias("_n_words"), F.char_length("_solid").cast("long").alias("_word_chars"), _without(F.col("_solid"), LATIN).alias("_rest"),
        duplicate_lines(F.col("_text")).alias("_n_dup_lines"), repeat_words(F.col("_words")).alias("_n_repeat_words"),
    ).drop("_solid")
    rows = rows.withColumn("_n_symbols", (F.char_length("_rest") - F.char_length(_without(F.col("_rest"), SYMBOLS))).cast("long"))
    failed = (F.col("_n_words") < LEAST_WORDS) | (100 * F.col("_n_repeat_words") > MOST_REPEAT_PCT * F.col("_n_words"))
    return rows.withColumn("_base_failed", failed)


def _normed(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return let(total, lambda t: F.transform(counts, lambda x: F.when(t > 0, x / t).otherwise(0.0)))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms that sum to 1."""
    term = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)
    parts = F.zip_with(p, q, lambda a, b: (term(a, b) + term(b, a)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)))


def common_words(docs: DataFrame) -> dict[str, list[str]]:
    """The words found in most documents of each language, from one bounded heavy-hitter sketch a language and task."""
    rows = docs.where(F.col("lang").isNotNull()).select("lang", F.explode(F.array_distinct(words_of(F.col("text")))).alias("word"))
    top = rows.groupBy("lang").agg(F.expr(f"approx_top_k(word, {COMMON_WORDS}, {TRACKED_WORDS})").alias("top")).collect()
    return {r.lang: sorted(x["item"] for x in r.top) for r in sorted(top)}


def histograms(rows: DataFrame, bins: dict[str, list[str]]) -> DataFrame:
    """``rows`` (_words, _rest, _lang, counts) with _chars (shares) and _tries (lang, shares of its bins).

    A document's own language is the one to try; a document without one, or
    with few common words of its own, is tried against all.
    """
    rows = rows.withColumn("_chars", char_shares(F.col("_word_chars"), F.col("_rest"), F.col("_n_words")))
    if not bins:
        return rows.withColumn("_tries", F.array().cast("array<struct<lang: string, shares: array<double>>>"))
    found = F.filter("_words", lambda w: w.isin(sorted({w for ws in bins.values() for w in ws})))
    n = F.greatest(F.col("_n_words"), F.lit(1))

    def shares(words: Column) -> Column:
        counts = F.transform(words, lambda b: F.size("_found") - F.size(F.array_remove(F.col("_found"), b)))
        return let(counts, lambda c: F.transform(F.concat(c, F.array((n - F.aggregate(c, F.lit(0), lambda a, x: a + x)).cast("int"))), lambda x: x / n))

    table = F.from_json(F.lit(json.dumps([{"lang": k, "words": v} for k, v in bins.items()])), "array<struct<lang: string, words: array<string>>>")
    tried = lambda refs: F.transform(refs, lambda r: F.struct(r.lang.alias("lang"), shares(r.words).alias("shares")))
    own = tried(F.filter(table, lambda r: r.lang == F.col("_lang")))
    enough = lambda t: F.exists(t, lambda r: F.element_at(r.shares, -1) <= 1 - FEW_COMMON)
    rows = rows.withColumn("_found", found)
    return rows.withColumn("_tries", let(own, lambda t: F.when(enough(t), t).otherwise(tried(table)))).drop("_found")


def references(hist: DataFrame, bins: dict[str, list[str]]) -> list[dict]:
    """Median histograms of each language over its documents (_lang, _n_words, _chars, _tries); a row a language."""
    rows = hist.where(F.col("_lang").isNotNull() & (F.col("_n_words") >= LEAST_WORDS))
    own = F.element_at(F.filter("_tries", lambda t: t.lang == F.col("_lang")).shares, 1)
    rows = rows.select("_lang", F.col("_chars").alias("c"), own.alias("w"))
    median = lambda c, i: F.percentile_approx(F.get(c, F.lit(i)), 0.5, MEDIAN_ACCURACY).alias(f"{c}{i}")
    out = []
    for r in rows.groupBy("_lang").agg(*[median("c", i) for i in range(4)], *[median("w", i) for i in range(COMMON_WORDS + 1)]).collect():
        chars, words = [r[f"c{i}"] for i in range(4)], [r[f"w{i}"] for i in range(len(bins[r._lang]) + 1)]
        out.append({"lang": r._lang, "chars": [x / sum(chars) for x in chars], "shares": [x / sum(words) for x in words]})
    return sorted(out, key=lambda r: r["lang"])


def diverges(refs: list[dict]) -> Column:
    """Whether _chars and _tries are far from every reference that was tried."""
    if not refs:
        return F.lit(False)
    table = F.from_json(F.lit(json.dumps(refs)), "array<struct<lang: string, chars: array<double>, shares: array<double>>>")
    n = F.col("_n_words")
    widest = MAX_CHAR_DISTANCE * F.sqrt(F.greatest(F.lit(1.0), MIN_WORDS_CHARS / F.greatest(n, F.lit(LEAST_WORDS))))

    def near(tried: Column) -> Column:
        def like(ref: Column) -> Column:
            chars = js_distance(F.col("_chars"), ref.chars) <= widest
            words = (n < MIN_WORDS_WORDS) | (js_distance(tried.shares, ref.shares) <= MAX_WORD_DISTANCE)
            return chars & words

        return F.exists(table, lambda ref: F.when(ref.lang == tried.lang, like(ref)).otherwise(False))

    return F.when(n < LEAST_WORDS, False).otherwise(~F.exists("_tries", near))


def _judged(rows: DataFrame, refs: list[dict]) -> DataFrame:
    return rows.withColumn("_kept", ~F.col("_base_failed") & ~diverges(refs))


COUNTS = ["_n_words", "_word_chars", "_n_symbols", "_n_dup_lines", "_n_repeat_words", "_base_failed"]


def assess(docs: DataFrame) -> DataFrame:
    """_id (doc_id), _tie, the base counts, the base verdict and _kept of every document.

    The texts are read twice: for the common words, and for the counts and
    histograms, which are written and judged from there.
    """
    bins = common_words(docs)
    rows = docs.select(F.col("doc_id").alias("_id"), _tie(), F.col("text").alias("_text"), F.col("lang").alias("_lang"))
    hist = histograms(base_counts(rows), bins).select("_id", "_tie", "_lang", *COUNTS, "_chars", "_tries")
    hist = staged(hist, "quality-histograms")
    return _judged(hist, references(hist, bins)).select("_id", "_tie", *COUNTS, "_kept")


def _tie() -> Column:
    """Tells documents under one doc_id apart by all that is judged."""
    return F.xxhash64("text", "lang").alias("_tie")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    gone = assess(docs).where(~F.col("_kept")).select(F.col("_id").alias("_g_id"), F.col("_tie").alias("_g_tie")).distinct()
    rows = packed(docs, _id="doc_id").withColumn("_tie", F.xxhash64("_row.text", "_row.lang"))
    return rows.join(gone, F.col("_id").eqNullSafe(F.col("_g_id")) & (F.col("_tie") == F.col("_g_tie")), "left_anti").select("_row.*")
