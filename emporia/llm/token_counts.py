"""Token counts: a two-tier, map-side lookup of pre-token lengths.

A BPE model never merges across a pre-token boundary, so a text's token count
is the sum of its pre-tokens' lengths.  The frequent pre-tokens' lengths are
broadcast as one bounded hash table; the others are encoded where they occur
and remembered in a bounded cache of the Python worker.  Pre-tokens of the
corpus are never shuffled: the frequent table comes from one bounded summary
per task, made over all documents, and only these summaries meet.

Cases: a null or empty text has 0 tokens and 0 bytes; a very long text is
counted slice by slice at pre-token boundaries; repeated rows give repeated
rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN_LIMIT = 4096
TABLE_SIZE = 20_000       # frequent pre-tokens that are broadcast
SUMMARY_SIZE = 2_000      # pre-tokens that one task reports
TRACKED = 200_000         # pre-tokens that one task counts at a time
CACHE_SIZE = 400_000      # lengths a worker remembers
CACHED_CHARS = 64         # longer pre-tokens are neither reported nor remembered
SLICE_CHARS = 1 << 20

SPACE = "▁"
_PIECES = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_CUT = re.compile(f"(?<=[^{SPACE}]){SPACE}")


def splits_at_spaces(model_path: str) -> bool:
    """Whether a sentencepiece model's tokens can be counted pre-token by pre-token.

    True for BPE models that keep the text as it is but for one leading space,
    and in whose vocabulary a space mark never follows another character.
    """
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(model_path, "rb") as f:
        model.ParseFromString(f.read())
    norm = model.normalizer_spec
    return (
        model.trainer_spec.model_type == pb.TrainerSpec.BPE
        and not model.trainer_spec.treat_whitespace_as_suffix
        and not norm.precompiled_charsmap
        and norm.add_dummy_prefix
        and not norm.remove_extra_whitespaces
        and norm.escape_whitespaces
        and not any(SPACE in p.piece.lstrip(SPACE) or p.type == pb.ModelProto.SentencePiece.USER_DEFINED for p in model.pieces)
    )


class PieceLengths:
    """Pre-tokens and their lengths under a sentencepiece model."""

    def __init__(self, path: str, by_word: bool):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.by_word = by_word

    def pre_tokens(self, text: str) -> Iterator[list[str]]:
        if not self.by_word:
            yield [text]
            return
        marked = SPACE + text.replace(" ", SPACE)
        start = 0
        while len(marked) - start > SLICE_CHARS and (cut := _CUT.search(marked, start + SLICE_CHARS)):
            yield _PIECES.findall(marked[start : cut.start()])
            start = cut.start()
        yield _PIECES.findall(marked[start:] if start else marked)

    def lengths(self, units: list[str]) -> list[int]:
        if not self.by_word:
            return [len(x) for x in self.model.encode(units, num_threads=1)]
        # the model itself puts one space mark in front; a lone mark is one token
        found = self.model.encode([u[1:] for u in units], num_threads=1)
        return [len(x) or 1 for x in found]


class JsonLengths:
    """Whole texts under a ``tokenizers`` file, special strings taken as ordinary text or not as the file says."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()

    def pre_tokens(self, text: str) -> Iterator[list[str]]:
        yield [text]

    def lengths(self, units: list[str]) -> list[int]:
        return [len(x.ids) for x in self.model.encode_batch(units, add_special_tokens=False)]


def _loader(path: str):
    if path.endswith(".json"):
        return lambda: JsonLengths(path)
    by_word = splits_at_spaces(path)
    return lambda: PieceLengths(path, by_word)


def frequent_pre_tokens(docs: DataFrame, load, table_size: int = TABLE_SIZE) -> list[str]:
    """The corpus's most frequent pre-tokens, from one bounded summary per task."""

    def summarise(batches):
        units, seen = load(), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for part in units.pre_tokens(text or ""):
                    seen.update(part)
                    if len(seen) > TRACKED:  # a new start for what was rare so far
                        seen = Counter({k: n for k, n in seen.most_common(TRACKED // 2) if n > 1})
        top = [(k, n) for k, n in seen.most_common(SUMMARY_SIZE) if n > 1 and 0 < len(k) <= CACHED_CHARS]
        yield pa.RecordBatch.from_pydict({"pre_token": [k for k, _ in top], "n": [n for _, n in top]}, schema=pa.schema([("pre_token", pa.string()), ("n", pa.int64())]))

    found = docs.select("text").mapInArrow(summarise, "pre_token string, n long").groupBy("pre_token").agg(F.sum("n").alias("n"))
    return [r.pre_token for r in found.orderBy(F.desc("n"), "pre_token").limit(table_size).collect()]


def token_counts(docs: DataFrame, model_path: str, limit: int = TOKEN_LIMIT, table_size: int = TABLE_SIZE) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text."""
    load = _loader(model_path)
    common = frequent_pre_tokens(docs, load, table_size) if table_size else []
    table = dict(zip(common, load().lengths(common), strict=True)) if common else {}
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def count(batches):
        units, first, cache = load(), shared.value, {}
        for batch in batches:
            totals = []
            for text in batch.column("text").to_pylist():
                total = 0
                for part in units.pre_tokens(text) if text else ():
                    known = list(map(first.get, part))
                    if None in known:
                        missed = [u for u, n in zip(part, known) if n is None]
                        if unknown := list({u for u in missed if u not in cache}):
                            if len(cache) > CACHE_SIZE:
                                cache.clear()
                                unknown = list(set(missed))
                            cache.update(zip(unknown, units.lengths(unknown)))
                        total += sum(map(cache.__getitem__, missed))
                        for u in unknown:
                            if len(u) > CACHED_CHARS:
                                del cache[u]
                        known = [n for n in known if n is not None]
                    total += sum(known)
                totals.append(total)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(totals, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select("doc_id", F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long")).alias("n_bytes"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"doc_id {id_type}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
