"""Language-model scores by a hidden Markov model over words.

Texts are lower-cased (A-Z) and split at white space; each ends with one end
token. A latent state gives a class of words (a hash bucket of fixed number; the
end has its own), and a class gives the word by its smoothed count, so a text's
probability is that of its classes under the hidden Markov model times that of
each word within its class. Baum-Welch runs over all training texts: every task
adds up expected counts with the scaled forward-backward recursion, Spark sums
them over tasks, and the driver, which sees states x classes numbers only, sets
the next model. The scaled forward recursion then gives each text's exact
likelihood.

Texts are kept as rows of a chunk each: word numbers, and the chunk's own word
list. A word's count over all training texts is summed over the chunks' lists
and brought back by chunk and place in the list, so no row per occurrence is
ever shuffled and a frequent word comes once per chunk.

Defined cases: a null or empty text is one end token; without training texts
every count is 0; rows are kept as often as they come; a null ``training`` value
is no training row. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from aisleflow.llm.common import bucketed, materialised, work_groups

STATES = 8
CLASSES = 1 << 14
ITERATIONS = 4
CHUNK_BYTES = 12_000_000
PRIOR = 3000.0
GROUP_TOKENS = 400_000
END = b""


def tokens_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words (bytes.lower changes A-Z only, bytes.split splits at space and 9 to 13), then the end."""
    words = (text or b"").lower().split()
    words.append(END)
    return words


def class_of(word: bytes) -> int:
    return zlib.crc32(word) % CLASSES if word else CLASSES


def _chunks(batches):
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        train = batch.column("_train")
        for a, b in work_groups(sizes, CHUNK_BYTES):
            number: defaultdict[bytes, int] = defaultdict()
            number.default_factory = number.__len__
            number[END]
            own, lengths = [], []
            for text in texts.slice(a, b - a).to_pylist():
                words = tokens_of(text)
                own.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
                lengths.append(len(words))
            ids = np.concatenate(own)
            in_training = np.repeat(train.slice(a, b - a).to_numpy(zero_copy_only=False), lengths)
            counts = np.bincount(ids[in_training], minlength=len(number))
            words = list(number)
            classes = np.fromiter(map(class_of, words), np.int32, len(words))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([batch.column("doc_id").slice(a, b - a).to_pylist()], pa.list_(batch.schema.field("doc_id").type)),
                    pa.array([train.slice(a, b - a).to_pylist()], pa.list_(pa.bool_())),
                    pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([ids.tobytes()], pa.binary()),
                    pa.array([classes.tobytes()], pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array([w.decode() for w in words], pa.string())),
                    pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(counts.astype(np.int64))),
                ],
                names=["doc_ids", "train", "lengths", "ids", "classes", "words", "counts"],
            )


def by_length(lengths: np.ndarray):
    """Sequences in groups of similar length, the longest first, each of about GROUP_TOKENS tokens."""
    order = np.argsort(-lengths, kind="stable")
    for a, b in work_groups(lengths[order].tolist(), GROUP_TOKENS):
        yield order[a:b]


def taken(symbols: np.ndarray, lengths: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The symbols of the chosen sequences, laid end to end."""
    ends = np.cumsum(lengths)
    return np.concatenate([symbols[ends[i] - lengths[i] : ends[i]] for i in chosen.tolist()])


class Lattice:
    """Sequences side by side: rows in order of position, at each position the longer sequences first."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        sorted_lengths = lengths[self.order]
        firsts = (np.cumsum(lengths) - lengths)[self.order]
        longest = int(sorted_lengths[0]) if len(lengths) else 0
        self.active = np.searchsorted(-sorted_lengths, -np.arange(1, longest + 1), "right")
        self.start = np.concatenate([[0], np.cumsum(self.active)])
        self.symbols = np.empty(len(symbols), np.int32)
        for t, a in enumerate(self.active.tolist()):
            self.symbols[self.start[t] : self.start[t] + a] = symbols[firsts[:a] + t]

    def steps(self) -> list[tuple[int, int]]:
        return list(zip(self.start[:-1].tolist(), self.active.tolist()))

    def forward(self, initial: np.ndarray, moves: np.ndarray, emitted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scaled forward probabilities and the scale of every row."""
        alpha, scale = np.empty_like(emitted), np.empty(len(emitted), emitted.dtype)
        now = None
        for s, a in self.steps():
            now = emitted[s : s + a] * (initial if now is None else now[:a] @ moves)
            total = now.sum(1)
            now /= total[:, None]
            alpha[s : s + a] = now
            scale[s : s + a] = total
        return alpha, scale

    def backward(self, moves: np.ndarray, emitted: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scaled backward probabilities, and what each row hands to the one before it."""
        beta, handed = np.ones_like(emitted), emitted / scale[:, None]
        steps = self.steps()
        back = moves.T.copy()
        for (s, a), (s1, a1) in zip(reversed(steps[:-1]), reversed(steps[1:])):
            handed[s1 : s1 + a1] *= beta[s1 : s1 + a1]
            beta[s : s + a1] = handed[s1 : s1 + a1] @ back
        return beta, handed


def expected_counts(lattice: Lattice, initial, moves, emissions) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected first states, moves and emissions of the sequences, and their log likelihood."""
    emitted = emissions.T[lattice.symbols]
    alpha, scale = lattice.forward(initial, moves, emitted)
    beta, handed = lattice.backward(moves, emitted, scale)
    gamma = alpha * beta
    n_first = int(lattice.active[0]) if len(lattice.active) else 0
    before = np.arange(n_first, len(lattice.symbols)) - np.repeat(lattice.active[:-1], lattice.active[1:])
    made = moves * (alpha[before].T @ handed[n_first:])
    out = np.stack([np.bincount(lattice.symbols, gamma[:, k], emissions.shape[1]) for k in range(len(initial))])
    return gamma[:n_first].sum(0), made, out, float(np.log(scale.astype(np.float64)).sum())


def _expectations(model):
    def run(batches):
        initial, moves, emissions = (x.astype(np.float32) for x in model.value)
        states, classes = emissions.shape
        sums = np.zeros((classes + states + 2, states))
        for batch in batches:
            for row in batch.to_pylist():
                lengths, train = np.array(row["lengths"]), np.array(row["train"], bool)
                if not train.any():
                    continue
                symbols = np.frombuffer(row["classes"], np.int32)[np.frombuffer(row["ids"], np.int32)]
                symbols, lengths = symbols[np.repeat(train, lengths)], lengths[train]
                for chosen in by_length(lengths):
                    lattice = Lattice(taken(symbols, lengths, chosen), lengths[chosen])
                    first, made, out, logp = expected_counts(lattice, initial, moves, emissions)
                    sums[:classes] += out.T
                    sums[classes : classes + states] += made
                    sums[classes + states] += first
                    sums[classes + states + 1] += logp / states
        slots = np.flatnonzero(sums.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots.astype(np.int32)), *(pa.array(sums[slots, k]) for k in range(states))],
            names=["slot", *(f"s{k}" for k in range(states))],
        )

    return run


def _first_model(mass: np.ndarray, states: int) -> tuple:
    random = np.random.default_rng(7)
    emissions = mass * random.uniform(0.5, 1.5, (states, len(mass)))
    moves = np.full((states, states), 0.1 / states) + np.eye(states) * 0.9
    return np.full(states, 1 / states), moves, emissions / emissions.sum(1, keepdims=True)


def baum_welch(chunks: DataFrame, mass: np.ndarray, states: int = STATES, iterations: int = ITERATIONS) -> tuple:
    """(initial, moves, emissions) after so many passes over all training texts; mass is the classes' share of words."""
    model = _first_model(mass, states)
    columns = [f"s{k}" for k in range(states)]
    classes = len(mass)
    for _ in range(iterations):
        shared = chunks.sparkSession.sparkContext.broadcast(model)
        sums = np.zeros((classes + states + 2, states))
        rows = (
            chunks.select("lengths", "train", "ids", "classes")
            .mapInArrow(_expectations(shared), "slot int, " + ", ".join(f"{c} double" for c in columns))
            .groupBy("slot")
            .agg(*(F.sum(c).alias(c) for c in columns))
            .collect()
        )  # one row per class and state
        for row in rows:
            sums[row.slot] = row[1:]
        emissions = sums[:classes].T + PRIOR * mass
        moves = sums[classes : classes + states] + 1.0
        initial = sums[classes + states] + 1.0
        model = (initial / initial.sum(), moves / moves.sum(1, keepdims=True), emissions / emissions.sum(1, keepdims=True))
        shared.unpersist()
    return model


def _scored(model, class_sizes, n_tokens: int, n_words: int, kind: pa.DataType):
    def run(chunk: pa.Table, counts: pa.Table) -> pa.Table:
        out = []
        initial, moves, emissions = model.value
        for row in chunk.to_pylist():
            ids, classes = np.frombuffer(row["ids"], np.int32), np.frombuffer(row["classes"], np.int32)
            lengths = np.array(row["lengths"])
            c = np.zeros(len(classes))
            c[counts.column("pos").to_numpy()] = counts.column("c").to_numpy()
            base = np.log10((c + 0.5) / (n_tokens + 0.5 * (n_words + 1)))
            within = np.log10((c + 0.5) / class_sizes.value[classes])
            hidden = np.zeros(len(lengths))
            for chosen in by_length(lengths):
                lattice = Lattice(taken(classes[ids], lengths, chosen), lengths[chosen])
                scale = lattice.forward(initial, moves, emissions.T[lattice.symbols])[1]
                owner = np.concatenate([lattice.order[:a] for a in lattice.active.tolist()])
                hidden[chosen] = np.bincount(owner, np.log10(scale), len(chosen))
            starts = np.cumsum(lengths) - lengths
            add = lambda x: np.add.reduceat(x[ids], starts)  # noqa: E731, B023
            out.append((row["doc_ids"], row["train"], lengths, add((c > 0).astype(np.int64)), add(base), hidden + add(within)))
        flat = lambda k: [x for row in out for x in row[k]]
        return pa.table(
            {
                "doc_id": pa.array(flat(0), kind),
                "train": pa.array(flat(1), pa.bool_()),
                "n_tokens": pa.array(flat(2), pa.int64()),
                "n_known": pa.array(flat(3), pa.int64()),
                "base_score": pa.array(flat(4), pa.float64()),
                "score": pa.array(flat(5), pa.float64()),
            }
        )

    return run


def score_texts(docs: DataFrame, training: Column) -> DataFrame:
    """Per document: doc_id, train, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities)."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    chunks = bucketed(
        docs.select("doc_id", "text", F.coalesce(training, F.lit(False)).alias("_train"))
        .mapInArrow(
            _chunks,
            f"doc_ids array<{kind}>, train array<boolean>, lengths array<long>, ids binary, classes binary, "
            "words array<string>, counts array<long>",
        )
        .withColumn("chunk", F.monotonically_increasing_id()),
        "word-chunks",
        "chunk",
    )
    listed = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts"))).select(
        "chunk", "pos", F.col("col.words").alias("word"), F.col("col.counts").alias("n")
    )
    of_word = Window.partitionBy("word").orderBy("chunk")
    counts = materialised(
        listed.select(
            "chunk",
            "pos",
            F.when(F.col("word") == "", CLASSES).otherwise(F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(CLASSES))).cast("int").alias("class"),
            F.sum("n").over(of_word.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("c"),
            (F.row_number().over(of_word) == 1).alias("first"),
        ).filter("c > 0"),
        "word-counts",
    )
    sizes = counts.filter("first").groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()
    occurrences, distinct = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    for row in sizes:  # at most one per class
        occurrences[row["class"]], distinct[row["class"]] = row.c, row.v
    class_sizes = occurrences + 0.5 * (distinct + 1)
    n_tokens, n_words = int(occurrences.sum()), int(distinct.sum())
    model = baum_welch(chunks, class_sizes / class_sizes.sum())
    arrow = pa.int64() if kind == "bigint" else pa.string() if kind == "string" else pa.int32()
    scored = (
        chunks.select("chunk", "doc_ids", "train", "lengths", "ids", "classes")
        .groupBy("chunk")
        .cogroup(counts.select("chunk", "pos", "c").groupBy("chunk"))
        .applyInArrow(
            _scored(spark.sparkContext.broadcast(model), spark.sparkContext.broadcast(class_sizes), n_tokens, n_words, arrow),
            f"doc_id {kind}, train boolean, n_tokens long, n_known long, base_score double, score double",
        )
    )
    return scored.withColumn("train_tokens", F.lit(n_tokens).cast("long"))
