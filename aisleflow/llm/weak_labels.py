"""Document quality from weak labels.

Heuristic labellers look at a text and vote good, bad or not at all. How often
each is right on good and on bad texts is estimated by expectation-maximisation
from the counts of vote patterns, of which there are at most 3 to the number of
labellers; each pattern so gets a posterior. The posteriors train a linear scorer
on hashed words and word shapes, which then scores every document.

All labellers vote from one list of words, one of lines and one array of character classes.
The first pass over the texts keeps the patterns, the last one votes and scores together.

Counts cover all documents. The scorer is fitted on at most ``FIT_ROWS``
documents, those of smallest hash (ties: smallest doc_id); that bound is a parameter.

Defined cases: a null or empty text gets no votes, posterior and score 0 and is
not kept; without votes of any kind posteriors are the prior; rows are kept as
often as they come, equal rows of the smallest hashes count as often in the fit; an empty
table gives an empty one; words and lines end at any Unicode blank; other columns may have any name.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from aisleflow.llm.common import CACHE_WORDS, materialised, work_groups

FIT_ROWS = 10_000
SLOTS = 1 << 16
EPOCHS = 6
ROUNDS = 60
KEEP_FROM = 0.5
GOOD_FIRST, BAD_FIRST, PRIOR = 0.99, 0.3, 20.0
BATCH_BYTES = 4_000_000
SHAPE = re.compile(r"([A-Z])[A-Z]*|([^\W\d_A-Z])[^\W\d_A-Z]*|(\d)\d*|([^\w\s])[^\w\s]*")

LETTER, UPPER, BLANK, NUMBER, ORDINARY, STOP = 1, 2, 4, 8, 16, 32


@cache
def _classes() -> np.ndarray:
    """The classes of each code point, as bits."""
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        c = chr(point)
        kind = unicodedata.category(c)
        table[point] = LETTER * (kind[0] == "L") | UPPER * (kind == "Lu") | NUMBER * (kind[0] == "N") | BLANK * c.isspace()
    table[[ord(c) for c in ".,;:'’\"()-"]] |= ORDINARY
    table[[ord(c) for c in ".;:,"]] |= STOP
    return table


def votes_of(text: str, words: list[str]) -> list[int | None]:
    """Votes of the labellers on a text and its words: 1 good, 0 bad, None none."""
    kinds = _classes()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    any_of = lambda mask: int(np.count_nonzero(kinds & mask))
    size, n, n_letters = len(text), len(words), max(any_of(LETTER), 1)
    edge = np.array([BLANK], np.uint8)
    after, before = np.concatenate([kinds[1:], edge]) & BLANK, np.concatenate([edge, kinds[:-1]]) & BLANK
    per_word = max(n, 1)
    symbols = (size - any_of(LETTER | NUMBER | BLANK | ORDINARY)) / max(size, 1)
    upper = any_of(UPPER) / n_letters
    ends = int(np.count_nonzero((kinds & STOP > 0) & (after > 0))) / per_word
    single = int(np.count_nonzero((kinds & (LETTER | NUMBER | BLANK) == 0) & (after > 0) & (before > 0))) / per_word
    stuck = sum(map(eq, words, words[1:])) / per_word
    lines = [line for line in text.split("\n") if line]
    repeated = 1 - len(set(lines)) / max(len(lines), 1)
    word_size = size / per_word
    vote = lambda bad, good: 0 if bad else 1 if good else None
    return [
        vote(symbols > 0.05, symbols < 0.01),
        vote(upper > 0.4, upper < 0.15),
        vote(stuck > 0.1, stuck < 0.03) if n >= 20 else None,
        vote(repeated > 0.3, repeated < 0.1) if len(lines) >= 4 else None,
        vote(ends == 0 or ends > 0.5, 0.03 <= ends <= 0.3) if n >= 20 else None,
        vote(single > 0.1, single == 0) if n >= 5 else None,
        vote(word_size < 3 or word_size > 14, 4 <= word_size <= 9) if n >= 5 else None,
    ]


LABELLERS = 7


def pattern_of(text: str | None, words: list[str]) -> int:
    """The votes as digits to the base 3: 0 none, 1 bad, 2 good."""
    code = 0
    for vote in votes_of(text, words) if text else []:
        code = code * 3 + (0 if vote is None else vote + 1)
    return code


def fit_accuracies(votes: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(share of good texts, P(vote good | good), P(vote bad | bad)) by expectation-maximisation.

    votes: patterns x labellers of 1, 0 and -1 (none); counts: texts per pattern.
    """
    # A labeller knows one kind of bad text: it seldom blames a good one and passes many bad ones.
    share, good, bad = 0.8, np.full(votes.shape[1], GOOD_FIRST), np.full(votes.shape[1], BAD_FIRST)
    for _ in range(ROUNDS):
        p = posteriors(votes, share, good, bad)
        up, down = counts * p, counts * (1 - p)
        share = float(np.clip((up.sum() + 1) / (counts.sum() + 2), 0.01, 0.99))
        good = ((votes == 1) * up[:, None]).sum(0) + PRIOR * GOOD_FIRST
        good /= good + ((votes == 0) * up[:, None]).sum(0) + PRIOR * (1 - GOOD_FIRST)
        bad = ((votes == 0) * down[:, None]).sum(0) + PRIOR * BAD_FIRST
        bad /= bad + ((votes == 1) * down[:, None]).sum(0) + PRIOR * (1 - BAD_FIRST)
    return share, good, bad


def posteriors(votes: np.ndarray, share: float, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """P(good) of each pattern."""
    odds = np.log(share / (1 - share)) + ((votes == 1) * np.log(good / (1 - bad)) + (votes == 0) * np.log((1 - good) / bad)).sum(1)
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


class WordSlots(dict):
    """Slots of a word and of its shape, as one number. A bounded memo; forgetting costs time only."""

    def __missing__(self, word: str) -> int:
        shape = SHAPE.sub(lambda m: "A" if m[1] else "a" if m[2] else "0" if m[3] else m[4], word)
        half = SLOTS // 2
        value = (zlib.crc32(word.lower().encode()) % half) * SLOTS + half + zlib.crc32(shape.encode()) % half
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value
        return value

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the words of a text and of their shapes, and their weights, of length 1."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0)
        counts = Counter(words)
        codes = np.fromiter(map(self.__getitem__, counts), np.int64, len(counts))
        n = np.fromiter(counts.values(), float, len(counts))
        found, at = np.unique(np.concatenate([codes // SLOTS, codes % SLOTS]), return_inverse=True)
        total = np.bincount(at, np.concatenate([n, n]))
        return found, total / np.sqrt((total * total).sum())


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]]) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer of (slots, weights, posterior) rows, by AdaGrad."""
    w, grown, bias, bias_grown = np.zeros(SLOTS), np.full(SLOTS, 1e-8), 0.0, 1e-8
    order = np.random.default_rng(3)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)).tolist():
            slots, x, y = rows[i]
            error = 1 / (1 + np.exp(-np.clip(w[slots] @ x + bias, -50, 50))) - y
            step = error * x
            grown[slots] += step * step
            w[slots] -= 0.5 * step / np.sqrt(grown[slots])
            bias_grown += error * error
            bias -= 0.5 * error / np.sqrt(bias_grown)
    return w, bias


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Batches cut to a bounded size of texts, with the texts."""
    for batch in batches:
        for a, b in work_groups(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist(), BATCH_BYTES):
            part = batch.slice(a, b - a)
            yield part, part.column("text").to_pylist()


def _voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in _texts(batches):
        patterns = [pattern_of(t, (t or "").split()) for t in texts]
        yield pa.RecordBatch.from_arrays([part.column("id"), part.column("h"), pa.array(patterns, pa.int32())], names=["id", "h", "pattern"])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = WordSlots()
    for part, texts in _texts(batches):
        found, patterns = [], []
        for text in texts:
            words = text.split()
            patterns.append(pattern_of(text, words))
            found.append(memo.features(words))
        yield pa.RecordBatch.from_arrays(
            [
                part.column("id"), part.column("h"), pa.array(patterns, pa.int32()),
                pa.array([s.tobytes() for s, _ in found], pa.binary()), pa.array([x.tobytes() for _, x in found], pa.binary()),
            ],
            names=["id", "h", "pattern", "slots", "x"],
        )


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, bias, posterior = model.value
        memo = WordSlots()
        for part, texts in _texts(batches):
            known, score = [], []
            for text in texts:
                words = (text or "").split()
                known.append(pattern_of(text, words))
                slots, x = memo.features(words)
                score.append(float(1 / (1 + np.exp(-np.clip(w[slots] @ x + bias, -50, 50)))) if len(slots) else 0.0)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array(known, pa.int32()),
                    pa.array([0.0 if not s else posterior[p] for s, p in zip(score, known)], pa.float64()), pa.array(score, pa.float64()),
                ],
                names=["doc_id", "pattern", "posterior", "score"],
            )

    return run


def quality(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per document: doc_id, pattern (votes as base-3 digits), posterior of the votes, score of the scorer, and keep."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    hashed = docs.select(F.col("doc_id").cast("string").alias("id"), F.xxhash64("doc_id", "text").alias("h"), "text")
    voted = materialised(hashed.mapInArrow(_voted, "id string, h bigint, pattern int"), "votes")
    counted = sorted(voted.groupBy("pattern").count().collect())  # at most 3 ** LABELLERS rows
    codes = np.array([r["pattern"] for r in counted], np.int64)
    digits = np.stack([codes // 3**k % 3 - 1 for k in range(LABELLERS - 1, -1, -1)], axis=1)
    posterior = dict(zip(codes.tolist(), posteriors(digits, *fit_accuracies(digits, np.array([r["count"] for r in counted], float))).tolist()))
    last = voted.orderBy("h", "id").limit(fit_rows).agg(F.max("h")).first()[0]
    chosen = hashed.filter((F.length("text") > 0) & (F.col("h") <= F.lit(last if last is not None else 0)))
    rows = chosen.mapInArrow(_featured, "id string, h bigint, pattern int, slots binary, x binary").collect()
    rows.sort(key=lambda r: (r.h, r.id or "", bytes(r.slots)))  # one order, whatever task ends first
    fitted = fit_scorer([(np.frombuffer(r.slots, np.int64), np.frombuffer(r.x), posterior[r.pattern]) for r in rows[:fit_rows]])
    model = spark.sparkContext.broadcast((*fitted, posterior))
    return (
        docs.select("doc_id", "text")
        .mapInArrow(_scored(model), f"doc_id {kind}, pattern int, posterior double, score double")
        .withColumn("keep", F.col("score") >= KEEP_FROM)
    )
