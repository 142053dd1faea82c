"""Language identification: script ranges, word scores and a Viterbi path.

Learnt from labelled documents: for each language, how often character
4-grams (hashed into ``GRAM_BUCKETS``) occur in its words, and which scripts
its letters belong to.  A word's score for a language is the sum of its grams'
log probabilities; a word whose script a language doesn't use rules that
language out for the word.  The best path over a text's words, with
``SWITCH_PENALTY`` for every change of language, labels spans of mixed text.
The document's language is the one whose spans hold most letters; its score
is their share of the letters.

Training takes about ``TRAIN_DOCS`` documents of each language at most, chosen
by a hash of the id; prediction covers every word of every text.  Paths of
many documents are computed together, word by word, in numpy.  A text longer
than a slice (``TEXT_CELLS`` characters x languages) is read slice by slice,
twice: blocks of its words are taken together, first for the best value from
each language before a block to each at its end, which joined in order give the
languages between the blocks, then for the path between those.  That is a best
path of the whole text; what stays in memory between slices is some numbers a
block.

Cases: a null text and one without letters are ``und`` with score 0; without
any labelled document everything is ``und``; a word in a script that no
language uses scores alike for all; ties go to the language first in order;
of equally good paths one is taken; slices end between words (a run of letters longer than a
slice counts as several words); repeated rows are
predicted alike; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 4
GRAM_BUCKETS = 1 << 15
TRAIN_DOCS = 4000
SWITCH_PENALTY = 12.0
SCRIPT_SHARE = 0.005      # a language uses a script from this share of its letters on
FORBIDDEN = -1e6
UNKNOWN = "und"
GROUP_CELLS = 1 << 22     # words (padded) x languages of the documents whose paths are computed together
TEXT_CELLS = 1 << 22      # characters x languages that are scored together
LEARN_CHARS = 1 << 20     # characters that are counted together when learning
BLOCK_WORDS = 256         # words of a block of a long text

# fixed values: Unicode ranges of scripts; letters outside them are script 1, "other"
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF), (0xFB1D, 0xFB4F)),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F), (0xA8E0, 0xA8FF)),
    "bengali": ((0x980, 0x9FF),),
    "tamil": ((0xB80, 0xBFF),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF), (0x1C90, 0x1CBF)),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)),
    "han": ((0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)),
}
N_SCRIPTS = len(SCRIPTS) + 2


@lru_cache(maxsize=1)
def script_table() -> np.ndarray:
    """Script number of every code point: 0 for what isn't a letter, 1 for other letters."""
    table = np.zeros(0x110000, np.uint8)
    letters = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)
    table[letters] = 1
    for k, ranges in enumerate(SCRIPTS.values()):
        for lo, hi in ranges:
            part = table[lo : hi + 1]
            part[part == 1] = k + 2
    return table


class Words:
    """Words (runs of letters) of some texts: their texts' numbers, lengths, scripts and hashed grams."""

    def __init__(self, texts: list[str | None]):
        joined = "\n".join((t or "").lower() for t in texts)
        points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
        scripts = script_table()[points]
        letter = scripts > 0
        edge = np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8))
        self.starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.lengths = ends - self.starts
        ends_of_text = np.cumsum([len((t or "").lower()) + 1 for t in texts])
        self.text = np.searchsorted(ends_of_text, self.starts, side="right")
        self.at = self.starts - np.concatenate([[0], ends_of_text])[self.text]  # within the lower-cased text
        # the grams end at a word's letters and at the gap after it; what lies before the word counts as one gap
        at = np.repeat(self.starts, self.lengths + 1) + _ramp(self.lengths + 1)
        first = np.repeat(self.starts, self.lengths + 1)
        hashed = np.zeros(len(at), np.uint64)
        for back in range(GRAM):
            where = at - back
            inside = (where >= first) & (where < np.repeat(ends, self.lengths + 1))
            value = np.where(inside, points[np.clip(where, 0, max(0, len(points) - 1))] if len(points) else 0, 32).astype(np.uint64)
            hashed = (hashed ^ value) * np.uint64(0x9E3779B97F4A7C15)
            hashed ^= hashed >> np.uint64(32)
        self.grams = (hashed % np.uint64(GRAM_BUCKETS)).astype(np.int32)
        self.gram_starts = np.concatenate([[0], np.cumsum(self.lengths + 1)])[:-1].astype(np.int64)
        self.scripts = scripts[self.starts] if len(self.starts) else np.zeros(0, np.uint8)
        self.letter_scripts = scripts[letter]


def _ramp(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each length, one after another."""
    total = int(lengths.sum())
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.arange(total) - starts


class Model:
    """Log probabilities of grams and the scripts in use, for the languages in order."""

    def __init__(self, languages: list[str], grams: np.ndarray, scripts: np.ndarray):
        self.languages = languages
        smooth = grams + 0.5
        self.logs = np.ascontiguousarray(np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32))
        share = scripts / np.maximum(1, scripts.sum(axis=1, keepdims=True))
        allowed = (share >= SCRIPT_SHARE).T  # script x language
        allowed[~allowed.any(axis=1)] = True
        self.bars = np.where(allowed, 0.0, FORBIDDEN).astype(np.float32)

    def scores(self, words: Words) -> np.ndarray:
        """Score of every word for every language."""
        if not len(words.starts):
            return np.zeros((0, len(self.languages)), np.float32)
        return np.add.reduceat(self.logs[words.grams], words.gram_starts, axis=0) + self.bars[words.scripts]


def best_paths(scores: np.ndarray, lengths: np.ndarray, penalty: float = SWITCH_PENALTY, enter: np.ndarray | None = None, leave: np.ndarray | None = None) -> np.ndarray:
    """The languages along each text's best path, for texts of similar length.

    ``scores``: texts x words (padded) x languages; ``lengths``: words of each text;
    ``enter``, ``leave``: the language before each text and the one it ends with, where they are given.
    """
    n, steps, langs = scores.shape
    came = np.zeros((steps, n, langs), np.int16)
    value = scores[:, 0].astype(np.float64)
    own = np.arange(langs, dtype=np.int16)
    if enter is not None:
        value -= np.where(own == enter[:, None], 0.0, penalty)
    for t in range(1, steps):
        top = value.argmax(axis=1)
        switched = value[np.arange(n), top][:, None] - penalty
        stay = value >= switched
        came[t] = np.where(stay, own, top[:, None].astype(np.int16))
        value = np.where((t < lengths)[:, None], np.where(stay, value, switched) + scores[:, t], value)
    path = np.zeros((n, steps), np.int16)
    state = value.argmax(axis=1).astype(np.int16) if leave is None else leave
    for t in range(steps - 1, -1, -1):
        inside = t < lengths
        path[:, t] = state
        if t:
            state = np.where(inside, came[t][np.arange(n), state], state)
    return path


def _paths(words: Words, scores: np.ndarray, n_texts: int) -> np.ndarray:
    """Language number of every word."""
    counts = np.bincount(words.text, minlength=n_texts)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    out = np.zeros(len(words.text), np.int16)
    order = np.argsort(counts, kind="stable")
    order = order[counts[order] > 0]
    while len(order):
        longest = int(counts[order[-1]])
        take = max(1, min(len(order), GROUP_CELLS // (longest * scores.shape[1])))
        group, order = order[-take:], order[:-take]
        lengths = counts[group]
        at = np.repeat(first[group], lengths) + _ramp(lengths)
        row, col = np.repeat(np.arange(take), lengths), _ramp(lengths)
        grid = np.zeros((take, longest, scores.shape[1]), np.float32)
        grid[row, col] = scores[at]
        out[at] = best_paths(grid, lengths)[row, col]
    return out


def _slices(text: str, chars: int):
    """The text in pieces of at most ``chars`` characters, cut after a character that is no letter where there is one."""
    scripts, a = script_table(), 0
    while len(text) - a > chars:
        b = a + chars
        while b > a and scripts[ord(text[b - 1])]:
            b -= 1
        b = a + chars if b == a else b
        yield text[a:b]
        a = b
    yield text[a:]


def _pieces(texts: list[str], chars: int):
    """Runs (first, last + 1) of texts of at most ``chars`` characters together; a longer text stands alone."""
    first, size = 0, 0
    for k, t in enumerate(texts):
        if k > first and size + len(t) > chars:
            yield first, k
            first, size = k, 0
        size += len(t)
    if texts:
        yield first, len(texts)


def _blocks(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words' scores as blocks x words (padded) x languages, and the words of each block."""
    n = -(-len(scores) // BLOCK_WORDS)
    grid = np.zeros((n * BLOCK_WORDS, scores.shape[1]), np.float32)
    grid[: len(scores)] = scores
    lengths = np.full(n, BLOCK_WORDS)
    lengths[-1] = len(scores) - (n - 1) * BLOCK_WORDS
    return grid.reshape(n, BLOCK_WORDS, -1), lengths


def _block_values(grid: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """Blocks x languages before x languages at the end: the value of the best path between them."""
    value = np.where(np.eye(grid.shape[2], dtype=bool), 0.0, -penalty) + grid[:, 0][:, None]
    for t in range(1, grid.shape[1]):
        further = np.maximum(value, value.max(axis=2, keepdims=True) - penalty) + grid[:, t][:, None]
        value = np.where((t < lengths)[:, None, None], further, value)
    return value


def long_paths(model: Model, text: str, chars: int):
    """(characters, words, language of each word) of every slice of a text, along one best path of the whole."""
    value, came = np.zeros(len(model.languages)), []
    for piece in _slices(text, chars):
        words = Words([piece])
        if not len(words.starts):
            came.append(np.zeros((0, len(value)), np.int16))
            continue
        steps = _block_values(*_blocks(model.scores(words)), SWITCH_PENALTY)
        best = np.zeros(steps.shape[::2], np.int16)
        for b, step in enumerate(steps):
            through = value[:, None] + step
            best[b], value = through.argmax(axis=0), through.max(axis=0)
        came.append(best)
    state, between = int(value.argmax()), []
    for best in reversed(came):
        states = np.zeros(len(best) + 1, np.int16)
        states[-1] = state
        for b in range(len(best) - 1, -1, -1):
            states[b] = state = int(best[b, state])
        between.append(states)
    for piece, states in zip(_slices(text, chars), reversed(between)):
        words = Words([piece])
        if len(words.starts):
            grid, lengths = _blocks(model.scores(words))
            yield len(piece.lower()), words, best_paths(grid, lengths, SWITCH_PENALTY, states[:-1], states[1:]).reshape(-1)[: len(words.starts)]
        else:
            yield len(piece.lower()), words, np.zeros(0, np.int16)


def _spans_of(words: Words, path: np.ndarray):
    """(text number, start, end, language number) of each run of words of one text and language."""
    cuts = np.flatnonzero((np.diff(path) != 0) | (np.diff(words.text) != 0)) + 1
    a, b = np.concatenate([[0], cuts]).astype(np.int64), np.concatenate([cuts, [len(path)]]).astype(np.int64) - 1
    return zip(words.text[a].tolist(), words.at[a].tolist(), (words.at[b] + words.lengths[b]).tolist(), path[a].tolist())


def label_texts(model: Model, texts: list[str | None]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """Language, score and spans (start, end, language; in characters of the lower-cased text) of each text."""
    langs = len(model.languages)
    letters = np.zeros((len(texts), langs), np.int64)
    spans: list[list] = [[] for _ in texts]
    chars = max(1 << 12, TEXT_CELLS // max(1, langs))
    short = [i for i, t in enumerate(texts) if t and len(t) <= chars and langs]
    for a, b in _pieces([texts[i] for i in short], chars):
        run = short[a:b]
        words = Words([texts[i] for i in run])
        if not len(words.starts):
            continue
        path = _paths(words, model.scores(words), len(run))
        letters[run] = np.bincount(words.text * langs + path, weights=words.lengths, minlength=len(run) * langs).reshape(len(run), langs)
        for k, start, end, lang in _spans_of(words, path):
            spans[run[k]].append((start, end, model.languages[lang]))
    for i, text in enumerate(texts):
        if not langs or not text or len(text) <= chars:
            continue
        before = 0
        for size, words, path in long_paths(model, text, chars):
            letters[i] += np.bincount(path, weights=words.lengths, minlength=langs).astype(np.int64)
            for _, start, end, lang in _spans_of(words, path) if len(path) else ():
                name = model.languages[lang]
                if spans[i] and spans[i][-1][2] == name:
                    spans[i][-1] = (spans[i][-1][0], before + end, name)
                else:
                    spans[i].append((before + start, before + end, name))
            before += size
    out = []
    for row, own in zip(letters, spans):
        total = int(row.sum())
        best = int(row.argmax()) if total else 0
        out.append((model.languages[best], float(row[best] / total), own) if total else (UNKNOWN, 0.0, own))
    return out


def predict_texts(model: Model, texts: list[str | None]) -> list[tuple[str, float]]:
    return [found[:2] for found in label_texts(model, texts)]


def spans(model: Model, text: str) -> list[tuple[int, int, str]]:
    """(start, end, language) of a text's spans, in characters of the lower-cased text."""
    return label_texts(model, [text])[0][2]


def learn(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """The model of about ``train_docs`` documents a language (doc_id, text, lang), chosen by a hash of the id."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("lang").alias("n")).collect()}  # a row a language
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((0, GRAM_BUCKETS)), np.zeros((0, N_SCRIPTS)))
    share = F.element_at(F.create_map(*[F.lit(x) for c in languages for x in (c, min(1.0, train_docs / counts[c]))]), F.col("lang"))
    chance = F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    sample = labelled.where(chance < share).select("lang", "text")

    def count(batches):
        sums: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(GRAM_BUCKETS + N_SCRIPTS, np.int64))
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts = batch.column("text").to_pylist()
            for lang in set(langs.tolist()):
                own = [piece for i in np.flatnonzero(langs == lang) for piece in _slices(texts[i], LEARN_CHARS)]
                for a, b in _pieces(own, LEARN_CHARS):
                    words = Words(own[a:b])
                    sums[lang][:GRAM_BUCKETS] += np.bincount(words.grams, minlength=GRAM_BUCKETS)
                    sums[lang][GRAM_BUCKETS:] += np.bincount(words.letter_scripts, minlength=N_SCRIPTS)
        for lang, s in sums.items():
            used = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(s[used], pa.int64())], names=["lang", "bin", "n"])

    found = sample.mapInArrow(count, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    table = np.zeros((len(languages), GRAM_BUCKETS + N_SCRIPTS))
    for r in found.toLocalIterator():  # at most languages x bins numbers
        table[languages.index(r.lang), r.bin] = r.n
    return Model(languages, table[:, :GRAM_BUCKETS], table[:, GRAM_BUCKETS:])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, spans (in characters of the lower-cased text) of every whole text; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())]))

    def label(batches):
        for batch in batches:
            found = label_texts(shared.value, batch.column("text").to_pylist())
            own = [[{"start": a, "stop": b, "lang": x} for a, b, x in f[2]] for f in found]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array(own, span)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "lang_pred", "score", "spans"])

    return docs.select("doc_id", "text").mapInArrow(label, f"doc_id {id_type}, lang_pred string, score double, spans array<struct<start: long, stop: long, lang: string>>")


def held_out(doc_id):
    """Whether a document is kept from learning: crc32 of its id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
