"""Language identification of mixed-language text.

Learning counts, per language, the letter trigrams of words (hashed into a fixed
number of buckets) and the letters of each script. A word's script leaves the
languages that write in it as candidates; its score in each of them is the log
probability of its trigrams. Viterbi over the words of a text, with a penalty
for changing language, labels spans; the text's language is the one whose spans
hold most letters, its score their share of all letters.

Everything a task does is array arithmetic over the letters of a group of texts,
and over the texts of the group for each word position. The model is
languages x buckets numbers, whatever the corpus holds.

Defined cases: a text that is null or has no letter is ``und`` with score 0 and
no spans, and so is every text when nothing was learned; words of a script that
no language writes in leave all languages as candidates with equal score; ties
go to the language first in sorted order. Rows are kept as often as they come;
other columns are not looked at.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from aisleflow.llm.common import work_groups

BUCKETS = 1 << 16
SWITCH_PENALTY = 12.0
SCRIPT_SHARE = 0.01
BATCH_BYTES = 6_000_000
UNKNOWN = "und"
LANGUAGES_AT_MOST = 1000

# First and last code points of the blocks of scripts.
SCRIPTS = [
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x06FF), ("arabic", 0x0750, 0x077F),
    ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF), ("gurmukhi", 0x0A00, 0x0A7F), ("gujarati", 0x0A80, 0x0AFF),
    ("tamil", 0x0B80, 0x0BFF), ("telugu", 0x0C00, 0x0C7F), ("kannada", 0x0C80, 0x0CFF), ("malayalam", 0x0D00, 0x0D7F),
    ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF), ("han", 0x20000, 0x3FFFF),
]
SCRIPT_NAMES = list(dict.fromkeys(name for name, _, _ in SCRIPTS)) + ["other"]


@lru_cache(1)
def _letters() -> np.ndarray:
    """Script number + 1 of every letter or mark, 0 of every other code point."""
    table = np.zeros(0x110000, np.uint8)
    scripts = np.full(0x110000, len(SCRIPT_NAMES), np.uint8)
    for name, first, last in SCRIPTS:
        scripts[first : last + 1] = SCRIPT_NAMES.index(name) + 1
    is_letter = np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(0x40000)), bool, 0x40000)
    table[:0x40000] = np.where(is_letter, scripts[:0x40000], 0)
    return table


@lru_cache(1)
def _marks() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[:0x40000] = np.fromiter((unicodedata.category(chr(c))[0] == "M" for c in range(0x40000)), bool, 0x40000)
    return table


def _after_a_letter(used: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """``used`` without the marks at the start of a run: a word begins with a letter, marks only go on with one."""
    mark = mark & used
    if not mark.any():
        return used
    place = np.arange(len(used))
    gap = np.maximum.accumulate(np.where(used, -1, place))
    letter = np.maximum.accumulate(np.where(used & ~mark, place, -1))
    return used & (letter > gap)


class Words:
    """Words (runs of letters) of texts laid end to end, and the trigram buckets of their letters."""

    def __init__(self, texts: list[str | None]):
        codes = [np.frombuffer(((t or "").lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        sizes = np.array([len(c) for c in codes], np.int64)
        code = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
        script = _letters()[code]
        letter = _after_a_letter(script > 0, _marks()[code])
        before = np.concatenate([[False], letter[:-1]]) if len(letter) else letter
        self.at = np.flatnonzero(letter & ~before)
        ends = np.flatnonzero(before & ~letter)  # the space after each text ends its last word
        self.length = ends - self.at
        self.text = np.searchsorted(np.cumsum(sizes), self.at, "right")
        self.offset = self.at - np.concatenate([[0], np.cumsum(sizes)])[self.text] if len(self.at) else self.at
        self.script = script[self.at] - 1 if len(self.at) else np.zeros(0, np.uint8)
        # Trigrams end at each letter and at the character after a word; what is not a letter counts as 0.
        c = np.where(letter, code, 0).astype(np.uint32)
        h = c * np.uint32(0x9E3779B1)
        h[1:] ^= c[:-1] * np.uint32(0x85EBCA77)
        both = c[:-2] * np.uint32(0xC2B2AE3D)
        both[~letter[1:-1]] = 0  # a trigram does not reach over a gap between words
        h[2:] ^= both
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(16)
        self.used = letter | before
        self.bucket = (h & np.uint32(BUCKETS - 1)).astype(np.int32)[self.used]
        self.starts = np.concatenate([[0], np.cumsum(self.length + 1)])[:-1]  # into bucket, by word


def _counted(batches):
    names: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, langs = batch.column("text"), batch.column("lang").to_pylist()
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        for a, b in work_groups(sizes, BATCH_BYTES):
            part, own = texts.slice(a, b - a).to_pylist(), langs[a:b]
            for lang in sorted(set(own)):
                w = Words([t for t, l in zip(part, own) if l == lang])
                counts = names.setdefault(lang, np.zeros(BUCKETS + len(SCRIPT_NAMES), np.int64))
                counts[:BUCKETS] += np.bincount(w.bucket, minlength=BUCKETS)
                counts[BUCKETS:] += np.bincount(w.script, w.length, len(SCRIPT_NAMES)).astype(np.int64)
    for lang, counts in names.items():
        slots = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(slots), pa.string()), pa.array(slots.astype(np.int32)), pa.array(counts[slots])],
            names=["lang", "slot", "n"],
        )


class Model:
    """Languages, log probabilities of trigram buckets and which scripts each language writes in."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        grams = counts[:, :BUCKETS] + 0.5
        self.logp = np.log(grams / grams.sum(1, keepdims=True)).T.astype(np.float32).copy()
        scripts = counts[:, BUCKETS:]
        shares = scripts / np.maximum(scripts.sum(1, keepdims=True), 1)
        self.allowed = (shares >= SCRIPT_SHARE).T.copy()
        self.unwritten = ~self.allowed.any(1)


def learn(docs: DataFrame, training: Column) -> Model:
    """A model from the texts of ``training`` rows whose lang is given. Only counts reach the driver."""
    counted = (
        docs.filter(training & F.col("lang").isNotNull() & F.col("text").isNotNull())
        .select("text", F.col("lang").cast("string").alias("lang"))
        .mapInArrow(_counted, "lang string, slot int, n long")
        .groupBy("lang", "slot")
        .agg(F.sum("n").alias("n"))
    )
    per_language = counted.groupBy("lang").agg(
        F.collect_list("slot").alias("slots"), F.collect_list("n").alias("ns")
    )  # at most BUCKETS and a few numbers per language
    rows = sorted(per_language.limit(LANGUAGES_AT_MOST + 1).collect(), key=lambda r: r.lang)
    if len(rows) > LANGUAGES_AT_MOST:
        raise ValueError(f"more than {LANGUAGES_AT_MOST} languages; is lang a language?")
    counts = np.zeros((len(rows), BUCKETS + len(SCRIPT_NAMES)), np.int64)
    for i, row in enumerate(rows):
        counts[i, row.slots] = row.ns
    return Model([r.lang for r in rows], counts)


def _word_scores(w: Words, model: Model) -> np.ndarray:
    """Log probability of each word in each language, low where the script rules a language out."""
    out = np.empty((len(w.at), len(model.langs)), np.float32)
    for i in range(len(model.langs)):
        out[:, i] = np.add.reduceat(model.logp[:, i][w.bucket], w.starts)
    out[~(model.allowed | model.unwritten[:, None])[w.script]] -= np.float32(1e4)
    out[model.unwritten[w.script]] = 0
    return out


def _best_path(scores: np.ndarray, firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Language of each word by Viterbi, all texts side by side. Words of text t are at firsts[t], counts[t] of them."""
    order = np.argsort(-counts, kind="stable")
    firsts, counts = firsts[order], counts[order]
    n = len(scores)
    came = np.zeros(scores.shape, np.int16)
    best = scores[firsts].astype(np.float64)
    active = np.searchsorted(-counts, -np.arange(1, (counts[0] if len(counts) else 0) + 1), "right")
    own = np.arange(scores.shape[1], dtype=np.int16)
    for t in range(1, len(active)):
        a = active[t]
        b = best[:a]
        top = b.argmax(1)
        other = b[np.arange(a), top] - SWITCH_PENALTY
        stay = b >= other[:, None]
        at = firsts[:a] + t
        came[at] = np.where(stay, own, top[:, None])
        best[:a] = np.where(stay, b, other[:, None]) + scores[at]
    label = np.zeros(n, np.int16)
    now = best.argmax(1)
    for t in range(len(active) - 1, -1, -1):
        a = active[t]
        at = firsts[:a] + t
        label[at] = now[:a]
        now[:a] = came[at, now[:a]]
    return label


def spans_of(texts: list[str | None], model: Model) -> list[tuple[str, float, list[dict]]]:
    """Language, score and spans (start, end, lang; in characters of the lower-cased text) of each text."""
    w = Words(texts)
    nothing = (UNKNOWN, 0.0, [])
    if not len(w.at) or not model.langs:
        return [nothing] * len(texts)
    counts = np.bincount(w.text, minlength=len(texts))
    firsts = np.concatenate([[0], np.cumsum(counts)])[:-1]
    has = np.flatnonzero(counts)
    label = _best_path(_word_scores(w, model), firsts[has], counts[has])
    letters = np.bincount(w.text * len(model.langs) + label, w.length, len(texts) * len(model.langs))
    letters = letters.reshape(len(texts), -1)
    top, total = letters.argmax(1), letters.sum(1)
    new = np.concatenate([[True], (np.diff(label) != 0) | (np.diff(w.text) != 0)])
    begin = np.flatnonzero(new)
    end = np.concatenate([begin[1:], [len(label)]]) - 1
    spans: list[list[dict]] = [[] for _ in texts]
    for t, s, e, l in zip(
        w.text[begin].tolist(), w.offset[begin].tolist(), (w.offset[end] + w.length[end]).tolist(), label[begin].tolist()
    ):
        spans[t].append({"start": s, "end": e, "lang": model.langs[l]})
    return [
        (model.langs[top[t]], float(letters[t, top[t]] / total[t]), spans[t]) if total[t] else nothing
        for t in range(len(texts))
    ]


def _identified(model):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.names.index("text"))
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for a, b in work_groups(sizes, BATCH_BYTES):
                found = spans_of(texts.slice(a, b - a).to_pylist(), model.value)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                        pa.array([f[2] for f in found], kind),
                    ],
                    names=[*part.schema.names, "lang_pred", "lang_score", "lang_spans"],
                )

    return run


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with lang_pred, lang_score and lang_spans; a column of such a name is replaced."""
    kept = [f"`{c}`" for c in docs.columns if c not in ("lang_pred", "lang_score", "lang_spans")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("lang", StringType())])
    added = [StructField("lang_pred", StringType()), StructField("lang_score", DoubleType()), StructField("lang_spans", ArrayType(own))]
    return docs.select(*kept).mapInArrow(_identified(shared), StructType([*docs.select(*kept).schema, *added]))


def _kept(model, least: float):
    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.names.index("text"))
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for a, b in work_groups(sizes, BATCH_BYTES):
                found = spans_of(texts.slice(a, b - a).to_pylist(), model.value)
                yield batch.slice(a, b - a).filter(pa.array([f[0] != UNKNOWN and f[1] >= least for f in found], pa.bool_()))

    return run


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents, as they are, of which one language holds at least ``least`` of the letters."""
    return docs.mapInArrow(_kept(docs.sparkSession.sparkContext.broadcast(model), least), docs.schema)
