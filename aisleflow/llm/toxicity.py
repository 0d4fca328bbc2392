"""Toxicity of texts whose words may be disguised: a noisy channel restores them, a linear model scores them.

Channel: a written character stands for itself, for a letter it looks like (``READINGS``),
for another copy of the letter before it, or, if it is neither letter nor digit, for
nothing or for the end of a word. A Viterbi search over this lattice finds the letters that are
likeliest under a character model of four letters, whose counts come from all documents. Only
words with a sign of disguise go through it (a digit or sign inside, three equal letters in a row,
two doubled ones, or a run of single characters with separators). Signs around a word that have no
reading, and a sign written twice or more at either end of it, are cut off first. Other words are
what they are.

Score: the features of a text are the restored words and their first ``PREFIXES`` letters.
Those that training documents with label 1 have more often than others (counted over all
labelled training texts, equal texts once for each label) become the inputs of a logistic
model: how often a feature occurs per word of the text, and whether any does.

Bounds: the character model has 28 ** 4 cells; at most ``MOST_FEATURES`` features are chosen;
the model is fitted on at most ``FIT_ROWS`` training texts of smallest hash. Everything else
covers all documents.

Defined cases: null and empty texts and texts without words get the score of a text without
features; without any label 1 or 0 in training every score is the share of label 1 with one
text of each label added; a null id is no training row; repeated rows are scored each; a
document with several labels counts with each; ties of features go to the smaller name. Other columns
are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from aisleflow.llm.common import CACHE_WORDS, materialised, work_groups

#: What signs and digits may stand for.
READINGS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
READ, REPEAT, DROP, END = 2.0, 1.5, 1.0, 2.5  # costs in nats
SYMBOLS, ORDER = 28, 4  # end of a word, a to z, digit
EDGE, DIGIT = 0, 27
SMOOTH = 0.5
PREFIXES = (4, 6)
MOST_FEATURES, FIT_ROWS, LEAST_SHARE, LEAST_TEXTS = 1024, 20_000, 0.005, 3
STEPS, RIDGE, TOXIC_FROM = 400, 1e-4, 0.3
BATCH_BYTES, FLUSH = 4_000_000, 200_000

_LETTER = re.compile(r"[^\W\d_]")
_SINGLE = re.compile(r"(?<!\S)(?:[^\W_][ .\-_*]{1,3}){2,}[^\W_](?!\S)")
_DOUBLED = re.compile(r"(.)\1(?:\1|.*(.)\2)")
_ORNAMENT = re.compile(r"^([^\w\s])\1+|([^\w\s])\2+$")
_NO_READING = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in READINGS)

# --- character model ----------------------------------------------------------


def _symbols() -> np.ndarray:
    """The symbol of each byte of lower-cased text; anything but a-z and digits ends a word."""
    table = np.zeros(256, np.uint8)
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    table[ord("0") : ord("9") + 1] = DIGIT
    return table


_SYMBOL = _symbols()


def gram_counts(texts: list[str | None]) -> np.ndarray:
    """Counts of the runs of ORDER symbols of the texts; a word's first letters follow ends of words."""
    data = np.frombuffer((" " + " ".join(t.lower() for t in texts if t) + " ").encode("utf-8", "replace"), np.uint8)
    s = _SYMBOL[data]
    s = s[np.concatenate([[True], (s[1:] != EDGE) | (s[:-1] != EDGE)])].astype(np.int32)  # one end between words
    code, inside = s.copy(), s != EDGE
    for back in range(1, ORDER):
        earlier = s[:-back]
        for between in range(1, back):  # an end of a word hides what is before it
            earlier = earlier * inside[between : len(s) - back + between]
        code[back:] += earlier * SYMBOLS**back
    return np.bincount(code[1:], minlength=SYMBOLS**ORDER)


def _counted_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS**ORDER, np.int64)
    for batch in batches:
        for a, b in work_groups(pc.fill_null(pc.binary_length(batch.column(0)), 0).to_pylist(), BATCH_BYTES):
            total += gram_counts(batch.column(0).slice(a, b - a).to_pylist())
    found = np.nonzero(total)[0]
    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["gram", "n"])


def costs_of(counts: np.ndarray) -> np.ndarray:
    """-log P(last symbol | the others) of each gram, each order smoothed by the next shorter one."""
    lower, cube = np.full((1, SYMBOLS), 1 / SYMBOLS), counts.reshape((SYMBOLS,) * ORDER).astype(float)
    for order in range(1, ORDER + 1):
        n = cube.sum(axis=tuple(range(ORDER - order))).reshape(-1, SYMBOLS)
        shorter = np.tile(lower, (n.shape[0] // lower.shape[0], 1))
        lower = (n + SMOOTH * SYMBOLS * shorter) / (n.sum(1, keepdims=True) + SMOOTH * SYMBOLS)
    return -np.log(lower).astype(np.float32).ravel()


def character_model(docs: DataFrame) -> np.ndarray:
    """Costs from the counts of all texts."""
    counts = np.zeros(SYMBOLS**ORDER, np.int64)
    summed = docs.select("text").mapInArrow(_counted_grams, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    for row in summed.toArrow().to_batches():  # at most SYMBOLS ** ORDER rows
        counts[row.column("gram").to_numpy()] = row.column("n").to_numpy()
    return costs_of(counts)


# --- noisy channel ------------------------------------------------------------


def _readings(c: str) -> list[tuple[str, int, float]]:
    """What a written character may stand for: (character, its symbol, cost)."""
    own = [(c, 0.0)] if c.isalnum() else []
    return [
        (r, EDGE if not r.isascii() else DIGIT if r.isdigit() else ord(r) - 96, cost)
        for r, cost in own + [(r, READ) for r in READINGS.get(c, "")]
    ]


def restore(written: str, costs: list[float]) -> str:
    """The likeliest letters behind ``written`` (lower case), words apart by single spaces."""
    # A state is the last three symbols as one number and the last letter itself; its value is (cost, back link).
    states: dict = {(0, ""): (0.0, None)}
    for c in written:
        readings, silent, after = _readings(c), not c.isalnum(), {}
        drop, end = DROP, 0.0 if c.isspace() else END
        for state, (cost, link) in states.items():
            context, last = state
            at = context * SYMBOLS
            for r, symbol, extra in readings:
                if symbol:
                    total, to = cost + extra + costs[at + symbol], ((at + symbol) % SYMBOLS**3, r)
                else:  # a letter outside a to z
                    total, to = cost + extra, (0, r)
                if to not in after or total < after[to][0]:
                    after[to] = (total, (link, r))
                if r == last:
                    total = cost + extra + REPEAT
                    if state not in after or total < after[state][0]:
                        after[state] = (total, link)
            if silent:
                if state not in after or cost + drop < after[state][0]:
                    after[state] = (cost + drop, link)
                total = cost + end + (costs[at] if context % SYMBOLS else 0.0)
                if (0, "") not in after or total < after[(0, "")][0]:
                    after[(0, "")] = (total, (link, " ") if last else link)
        states = after
    ended = lambda e: e[1][0] + (costs[e[0][0] * SYMBOLS] if e[0][0] % SYMBOLS else 0.0)
    link = min(states.items(), key=lambda e: (ended(e), e[0]))[1][1]
    found = []
    while link is not None:
        link, r = link
        found.append(r)
    return " ".join("".join(reversed(found)).split())


def disguised(word: str) -> bool:
    """Whether a word without its outer signs shows a sign of disguise."""
    if not word.isalpha():
        return any(c.isalpha() for c in word)
    return bool(_DOUBLED.search(word))


class Restorer(dict):
    """Restored words of a written word without blanks. A bounded memo; forgetting costs time only."""

    def __init__(self, costs: np.ndarray):
        super().__init__()
        self.costs = costs.tolist()

    def __missing__(self, written: str) -> tuple[str, ...]:
        words = self.plain(written)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[written] = words
        return words

    def plain(self, written: str) -> tuple[str, ...]:
        """The words behind a written word, without a look at the memo."""
        if written.isalpha() and not _DOUBLED.search(written):
            return (written,)
        core = written.strip(_NO_READING)
        if not core.isalpha():
            core = _ORNAMENT.sub("", core).strip(_NO_READING)
        return tuple(restore(core, self.costs).split()) if disguised(core) else (core,) if core else ()

    def written(self, text: str | None) -> Iterable[tuple[str, int]]:
        """Written words of a text with their counts; runs of single characters are words with blanks inside."""
        if not text:
            return ()
        text = text.lower()
        spaced = _SINGLE.findall(text)
        if spaced:
            text = _SINGLE.sub(" ", text)
        counts = Counter(text.split())
        counts.update(spaced)  # never among the others, which have no blanks
        return counts.items()

    def words(self, text: str | None) -> list[tuple[str, int]]:
        """Restored words of a text and how often each written word they come from occurs."""
        return [(word, n) for written, n in self.written(text) for word in self.restored(written)]

    def restored(self, written: str) -> tuple[str, ...]:
        return self.run(written) if " " in written else self[written]

    def run(self, written: str) -> tuple[str, ...]:
        """Words of a run of single characters; a run of one repeated character is left out."""
        letters = {c for c in written if c.isalnum()}
        return tuple(restore(written, self.costs).split()) if len(letters) > 1 else ()


def features_of(word: str) -> list[str]:
    """A restored word and its beginnings; = marks the end of a whole word."""
    return [word + "=", *(word[:k] for k in PREFIXES if len(word) >= k)]


# --- learning -----------------------------------------------------------------


NO_FEATURE: tuple[int, list[list[int]]] = (1, [])


class Inputs(dict):
    """The model's inputs of a text: per chosen feature its share of the words, and two sums.

    As a memo it holds, for a written word, how many words it stands for and the chosen features of
    those that have any. It is bounded; forgetting costs time only.
    """

    def __init__(self, restorer: Restorer, features: list[str]):
        super().__init__()
        self.restorer, self.at, self.size = restorer, {f: k for k, f in enumerate(features)}, len(features) + 2
        self.heads = {f[: PREFIXES[0]] for f in features}

    def __missing__(self, written: str) -> tuple[int, list[list[int]]]:
        if written.isalpha() and not _DOUBLED.search(written):  # most words: what they are
            value = self.of_word(written)
        else:
            words = self.restorer.run(written) if " " in written else self.restorer.plain(written)
            value = len(words), [found for w in words for found in self.of_word(w)[1]]
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[written] = value
        return value

    def of_word(self, word: str) -> tuple[int, list[list[int]]]:
        """A word, and its chosen features if it has any."""
        if (word if len(word) >= PREFIXES[0] else word + "=")[: PREFIXES[0]] not in self.heads:
            return NO_FEATURE
        found = [self.at[f] for f in features_of(word) if f in self.at]
        return (1, [found]) if found else NO_FEATURE

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        counts: dict[int, int] = {}
        total = hits = 0
        for written, n in self.restorer.written(text):
            words, found = self[written]
            total += n * words
            hits += n * len(found)
            for slots in found:
                for k in slots:
                    counts[k] = counts.get(k, 0) + n
        if not hits:
            return np.zeros(0, np.int64), np.zeros(0)
        slots = np.fromiter(counts, np.int64, len(counts))
        shares = np.fromiter(counts.values(), float, len(counts)) / total
        shape = np.array([np.sqrt(hits / total), np.log1p(hits) / 5])
        return np.concatenate([slots, [self.size - 2, self.size - 1]]), np.concatenate([np.sqrt(shares), shape])


def _counted(per_text):
    """How many texts of each label have a feature; ``per_text`` gives the distinct features of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, counts = per_text(), Counter()

        def out():
            keys = list(counts)
            return pa.RecordBatch.from_arrays(
                [pa.array([f for f, _ in keys], pa.string()), pa.array([y for _, y in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64())],
                names=["feature", "toxic", "n"],
            )

        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                counts.update((f, label) for f in find(text.as_py()))
                if len(counts) >= FLUSH:
                    yield out()
                    counts.clear()
        yield out()

    return run


def _all_features(costs):
    """Every feature of a text."""

    def start():
        restorer = Restorer(costs.value)
        return lambda text: {f for word, _ in restorer.words(text) for f in features_of(word)}

    return _counted(start)


def _known_features(costs, known):
    """The features of a text that are among ``known``."""

    def start():
        names = known.value
        inputs = Inputs(Restorer(costs.value), names)
        return lambda text: {names[k] for written, _ in inputs.restorer.written(text) for found in inputs[written][1] for k in found}

    return _counted(start)


def _inputs(costs, features):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inputs = Inputs(Restorer(costs.value), features.value)
        for batch in batches:
            found = [inputs.of(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array([s.tobytes() for s, _ in found], pa.binary()), pa.array([x.tobytes() for _, x in found], pa.binary())],
                names=["toxic", "slots", "x"],
            )

    return run


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], size: int) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model, by gradient steps scaled per input over all rows."""
    n = np.fromiter((len(s) for s, _, _ in rows), np.int64, len(rows))
    of = np.repeat(np.arange(len(rows)), n)
    slots, x = np.concatenate([s for s, _, _ in rows]), np.concatenate([v for _, v, _ in rows])
    y = np.array([t for _, _, t in rows], float)
    share = (y.sum() + 1) / (len(y) + 2)
    w, bias, grown, bias_grown = np.zeros(size), float(np.log(share / (1 - share))), np.full(size, 1e-8), 1e-8
    for _ in range(STEPS):
        error = 1 / (1 + np.exp(-np.clip(np.bincount(of, w[slots] * x, len(rows)) + bias, -50, 50))) - y
        step = np.bincount(slots, error[of] * x, size) / len(rows) + RIDGE * w
        grown += step * step
        w -= 0.5 * step / np.sqrt(grown)
        bias_grown += error.mean() ** 2
        bias -= 0.1 * error.mean() / np.sqrt(bias_grown)
    return w, bias


def _telling(counted: DataFrame, of_label: dict[int, int]) -> list[str]:
    """Features by how far label 1 has them above label 0, in standard deviations; all are kept only above 4."""
    ones, zeros = of_label.get(1, 0), of_label.get(0, 0)
    per = counted.groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("p"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("q")
    )
    share = (F.col("p") + F.col("q")) / (ones + zeros)
    spread = F.sqrt(share * (1 - share) * (1 / ones + 1 / zeros)) + 1e-9
    z = (F.col("p") / ones - F.col("q") / zeros) / spread
    return [r.feature for r in per.withColumn("z", z).filter("z > 4").orderBy(F.desc("z"), "feature").limit(MOST_FEATURES).select("feature").collect()]


def _labelled_texts(docs: DataFrame, labels: DataFrame, training: Column) -> DataFrame:
    """toxic, h (a hash) and text of labelled training documents, equal texts once for each label.

    Which documents those are is found from ids and digests alone; then their texts are fetched by one
    join. Labels grow with the documents, so they are never broadcast for it.
    """
    marks = labels.filter(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    own = docs.filter(training & (F.length("text") > 0)).select("doc_id", F.md5("text").alias("digest"), F.xxhash64("text").alias("h"), "text")
    chosen = own.drop("text").join(marks, "doc_id").groupBy("toxic", "digest").agg(F.min("doc_id").alias("doc_id"), F.min("h").alias("h"))
    fetched = own.drop("h").join(chosen.hint("merge"), ["doc_id", "digest"])
    return materialised(fetched.groupBy("doc_id", "digest", "toxic", "h").agg(F.any_value("text").alias("text")).select("toxic", "h", "text"), "labelled")


def _per_label(texts: DataFrame, label: int, run) -> DataFrame:
    own = texts.filter(F.col("toxic") == label).select("text", "toxic")
    return own.mapInArrow(run, "feature string, toxic int, n bigint").groupBy("feature", "toxic").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, labels: DataFrame, training: Column) -> tuple:
    """(character costs, chosen features, weights, bias) from the documents for which ``training`` holds."""
    spark = docs.sparkSession
    costs = character_model(docs)
    sent = spark.sparkContext.broadcast(costs)
    once = _labelled_texts(docs, labels, training)
    of_label = {r.toxic: r["count"] for r in once.groupBy("toxic").count().collect()}
    ones, zeros = of_label.get(1, 0), of_label.get(0, 0)
    share = (ones + 1) / (ones + zeros + 2)
    nothing = costs, [], np.zeros(2), float(np.log(share / (1 - share)))
    if not ones or not zeros:
        return nothing
    least = max(LEAST_TEXTS, int(LEAST_SHARE * ones))  # so candidates are at most the features of 1 / LEAST_SHARE texts
    positive = _per_label(once, 1, _all_features(sent)).filter(F.col("n") >= least)
    positive = materialised(positive, "candidates")
    candidates = spark.sparkContext.broadcast(sorted(r.feature for r in positive.select("feature").collect()))
    negative = _per_label(once, 0, _known_features(sent, candidates))
    chosen = _telling(positive.unionAll(negative), of_label)
    if not chosen:
        return nothing
    names = spark.sparkContext.broadcast(chosen)
    last = once.select("h").orderBy("h").limit(FIT_ROWS).agg(F.max("h")).first()[0]
    rows = once.filter(F.col("h") <= F.lit(last)).select("text", "toxic").mapInArrow(_inputs(sent, names), "toxic int, slots binary, x binary").collect()
    parts = sorted((r.toxic, bytes(r.slots), bytes(r.x)) for r in rows)  # the same order whatever task ends first
    return costs, chosen, *fit([(np.frombuffer(s, np.int64), np.frombuffer(x), y) for y, s, x in parts], len(chosen) + 2)


# --- scoring ------------------------------------------------------------------


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs, features, w, bias = model.value
        inputs = Inputs(Restorer(costs), features)
        for batch in batches:
            for a, b in work_groups(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist(), BATCH_BYTES):
                part, scores = batch.slice(a, b - a), []
                for text in part.column("text").to_pylist():
                    slots, x = inputs.of(text)
                    scores.append(1 / (1 + float(np.exp(-np.clip(w[slots] @ x + bias, -50, 50)))))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model: tuple) -> DataFrame:
    """doc_id and score of each document: how likely label 1 is."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(_scored(sent), f"doc_id {kind}, score double")
