"""The corpus operators' registered queries and, where SQL can express them, DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm import chat, decontam, html_text, langid, line_dedup, merkle, minhash, mixing, prefix_trie, quality, simhash, token_counts, warc
from emporia.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "piece_bpe_32k.model"


def _query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@_query("op1_token_counts")
def token_counts_query(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


@_query("op2_mixing")
def mixing_query(spark, sf_dir):
    weights = mixing.label_weights(table(spark, sf_dir, "labels"))
    return mixing.mixing_plan(table(spark, sf_dir, "documents"), weights).select("doc_id", "size", "source_size", "target", "taken", "source")


@_query("op3_quality")
def quality_query(spark, sf_dir):
    judged = quality.assess(table(spark, sf_dir, "documents"))
    named = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select(F.col("_id").alias("doc_id"), *[F.col(f"_{c}").alias(c) for c in named])


@_query("op4_decontamination")
def decontamination_query(spark, sf_dir):
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP_SQL = f"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos
  from documents
), keyed as (
  select *, translate(trim(line, {SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines
), owned as (
  select key, max(doc_id) as owner from keyed where length(key) >= 20 group by key having count(distinct doc_id) >= 3
), marked as (
  select k.*, o.owner is not null and o.owner <> k.doc_id as dropped from keyed k left join owned o using (key)
)
select doc_id, count(*)::bigint as n_lines, count(*) filter (dropped)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not dropped), '')) as kept_sha256
from marked group by doc_id
"""


@_query("op5_line_dedup", LINE_DEDUP_SQL)
def line_dedup_query(spark, sf_dir):
    rows = line_dedup.with_bitmaps(table(spark, sf_dir, "documents"))
    n_dropped = F.coalesce(F.aggregate("_runs", F.lit(0), lambda n, r: n + r.length), F.lit(0)).cast("long")
    kept = line_dedup.kept_text(F.coalesce("_text", F.lit("")), F.col("_runs"))
    return rows.select(
        F.col("_id").alias("doc_id"), F.size(line_dedup.lines_of(F.col("_text"))).cast("long").alias("n_lines"), n_dropped.alias("n_dropped"), F.sha2(kept, 256).alias("kept_sha256"),
    )


NEAR_DUPLICATES_SQL = r"""
with recursive words as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents
), shingles as (
  select distinct doc_id, array_to_string(w[i : i + 4], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) as i from words where len(w) > 0)
), sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2
), links as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)
), both_ways as (select a, b from links union select b, a from links),
reach(node, root) as (
  select a, a from both_ways union select l.b, r.root from reach r join both_ways l on l.a = r.node
), heads as (select node, min(root) as component from reach group by node)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles, coalesce(h.component, d.doc_id) as component_id, coalesce(h.component, d.doc_id) = d.doc_id as kept
from documents d left join sizes s using (doc_id) left join heads h on h.node = d.doc_id
"""


@_query("op6_minhash", NEAR_DUPLICATES_SQL)
def minhash_query(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


WARC_SQL = """
with p as (select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as n from pages),
d as (select *, max(page_id) over (partition by html) as last from p)
select page_id, n::bigint as payload_bytes, sha1(html) as payload_digest,
       case when n >= 1000 and last <> page_id then 'revisit' else 'response' end as record_type,
       case when n >= 1000 and last <> page_id then last end as refers_to
from d
"""


@_query("op7_warc", WARC_SQL)
def warc_query(spark, sf_dir):
    return warc.page_rows(warc.archive_and_read(table(spark, sf_dir, "pages")))


@_query("op8_language_id")
def language_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "spans")


@_query("op9_chat_format")
def chat_query(spark, sf_dir):
    return chat.format_chats(table(spark, sf_dir, "conversations"))


@_query("op10_html_text")
def html_query(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@_query("op11_prefix_trie")
def prefix_trie_query(spark, sf_dir):
    return prefix_trie.trie(*prefix_trie.rebuilt(*prefix_trie.turn_ids(table(spark, sf_dir, "conversations"))))


@_query("op12_simhash")
def simhash_query(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@_query("op13_merkle")
def merkle_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(*MANIFEST_FIELDS)
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    fields = [line_dedup.ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in MANIFEST_FIELDS]
    rows = merkle.manifest(docs.withColumn("tampered", F.when(changed, merkle.leaf_digest(fields))), MANIFEST_FIELDS, "lang", "doc_id", carry=["tampered"])
    rows = rows.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
