"""Spelling variants: words one edit apart, grouped under the far more frequent form.

Words become vectors of letter counts. One deletion or insertion moves a vector by a
squared distance of 1 and the length by 1; one replacement moves it by 2 and leaves the
length. The letters are dealt into ``GROUPS`` groups; at most two letters differ, so two
near words agree in all letters of at least ``GROUPS - 2`` groups, and words are blocked by
each choice of so many groups. In a block, sorted by length, NumPy products of count
matrices (Gram matrices) of two tiles give the squared distances of all their words at once;
tiles whose lengths are not adjacent are passed over. Pairs of distance 1 or 2 are then
compared letter by letter. A pair counts in the first block in which it meets only.

Blocks of more than ``BLOCK`` words are cut into cells, and each two cells are a block of
their own, so no task holds more than two cells of a block. What leaves a block is one
row per word (near words and the best of them), not its pairs.

A word's form is its near word of largest count, if that is ``RATIO`` times its own count or
more; along forms counts grow by that factor, so chains are short and pointer jumping
finds their ends in a number of rounds known beforehand.

Defined cases: null and empty texts have no words; a null id counts as empty text where ids
are mixed into the hash; repeated rows count as often as they come; words are runs of A-Z,
a-z and U+00C0 to U+00FF, so accents stay and other letters end a run; words of any length
are compared; ties of the count go to the smaller word in code-point order; an empty table
has no words. Other columns are not looked at.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from aisleflow.llm.common import U64, materialised, mixed

LEAST_LENGTH, LEAST_COUNT, RATIO, SPOILED = 7, 2, 10, 31
GROUPS, BLOCK, TILE, BATCH = 4, 4096, 256, 50_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Roughly from the most frequent letter of western languages to the rarest.
BY_FREQUENCY = "eantirosludhcmgpbfvyzkwqjx"
FIRST_ACCENT, LETTERS = 0xC0, 26 + 64
EXACT_IN_FLOAT32, PADDED = 2000, 48

CHOICES = list(itertools.combinations(range(GROUPS), GROUPS - 2))
PARTIAL = "word string, n bigint, n_near bigint, best struct<n:bigint,word:string>"


def _groups() -> np.ndarray:
    """The group of each letter; letters go to and fro over the groups, frequent ones first."""
    turn = [*range(GROUPS), *reversed(range(GROUPS))]
    order = [ord(c) - ord("a") for c in BY_FREQUENCY] + list(range(26, LETTERS))
    group = np.zeros(LETTERS, np.int64)
    group[order] = [turn[k % len(turn)] for k in range(LETTERS)]
    return group


GROUP_OF = _groups()


def words(docs: DataFrame) -> DataFrame:
    """word and n of the long words of ``text``, each SPOILED-th run of a document without one letter."""
    long_runs = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}"), F.lit(0))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("i"), F.explode(long_runs).alias("run"))
    runs = runs.select("i", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("i", F.lit(":"), "run").cast("binary"))
    return counted(runs.select(F.when(h % SPOILED == 0, _without(F.col("run"), h)).otherwise(F.col("run")).alias("word")))


def _without(run: Column, h: Column) -> Column:
    at = (h % F.length(run)).cast("int")
    return F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))


def counted(found: DataFrame) -> DataFrame:
    """Words of at least LEAST_LENGTH letters and LEAST_COUNT occurrences."""
    return found.filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


# --- letter counts ------------------------------------------------------------


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter numbers of all words one after the other, and the words' lengths."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    return np.where(points < FIRST_ACCENT, points - ord("a"), points - FIRST_ACCENT + 26), sizes


def letter_counts(texts: list[str]) -> np.ndarray:
    letters, sizes = _letters(texts)
    row = np.repeat(np.arange(len(texts)), sizes)
    return np.bincount(row * LETTERS + letters, minlength=len(texts) * LETTERS).reshape(-1, LETTERS)


def block_keys(texts: list[str]) -> np.ndarray:
    """A hash of the letters of each choice of groups: choices x words, as signed 64-bit numbers."""
    letters, sizes = _letters(texts)
    starts = np.cumsum(sizes) - sizes
    value = mixed(np.arange(1, LETTERS + 1).astype(U64))[letters]
    by_group = [np.add.reduceat(np.where(GROUP_OF[letters] == g, value, U64(0)), starts) for g in range(GROUPS)]
    return np.stack([mixed(sum((by_group[g] * U64(2 * g + 3) for g in choice), U64(k))) for k, choice in enumerate(CHOICES)]).view(np.int64)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        word, n = batch.column("word"), batch.column("n")
        for k, keys in enumerate(block_keys(word.to_pylist())):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), k, np.int32)), pa.array(keys), word, n], names=["choice", "key", "word", "n"])


# --- near words of a block ----------------------------------------------------


class _Tile:
    """Some neighbouring words: their counts, squared norms and letters padded with zeros."""

    def __init__(self, texts: list[str]):
        self.counts = letter_counts(texts)
        _, self.sizes = _letters(texts)
        widest = int(self.sizes.max())
        kind = np.float32 if widest <= EXACT_IN_FLOAT32 else np.float64
        self.vectors = self.counts.astype(kind)
        self.norms = (self.vectors * self.vectors).sum(1)
        self.letters = None
        if widest <= PADDED:
            self.letters = np.zeros((len(texts), PADDED + 1), np.uint8)
            self.letters[np.arange(PADDED + 1)[None, :] < self.sizes[:, None]] = _letters(texts)[0] + 1

    def candidates(self, other: _Tile, together: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows whose squared distance is 1 or 2, by one product of the two count matrices."""
        apart = self.vectors @ other.vectors.T
        apart *= -2
        apart += self.norms[:, None]
        apart += other.norms[None, :]
        x, y = np.nonzero((apart <= 2) & together)
        gap, apart = np.abs(self.sizes[x] - other.sizes[y]), apart[x, y]
        fits = ((apart == 1) & (gap == 1)) | ((apart == 2) & (gap == 0))
        return x[fits], y[fits]


def _one_edit_apart(p: np.ndarray, q: np.ndarray, size_p: np.ndarray, size_q: np.ndarray) -> np.ndarray:
    """Which rows of padded letters differ by one replaced or one left out letter; lengths are at most 1 apart."""
    alike = p == q
    good = alike.sum(1) == p.shape[1] - 1
    other = np.nonzero(size_p != size_q)[0]
    longer = (size_p[other] > size_q[other])[:, None]
    a, b = p[other], q[other]
    moved = np.where(longer, a, b)[:, 1:] == np.where(longer, b, a)[:, :-1]  # letters alike one place on
    ahead = alike[other].argmin(1)  # the first place where they differ
    behind = moved[:, ::-1].argmin(1)  # how many are alike from the end
    behind[moved.all(1)] = moved.shape[1]
    good[other] = ahead + behind >= moved.shape[1]
    return good


def one_edit_apart(a: str, b: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


class _Rows:
    """The sorted rows of one task: blocks lie one after the other, lengths ascend within a block."""

    def __init__(self, choice, key, i, j, own, texts):
        self.choice, self.own, self.crossing, self.texts = choice, own, i != j, texts
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        changes = (np.diff(choice) != 0) | (np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)
        self.block = np.concatenate([[0], np.cumsum(changes)])
        self.ends = np.searchsorted(self.block, self.block, "right")

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Near words, each pair once and only in the first block in which it meets."""
        starts = list(range(0, len(self.texts), TILE))
        tiles: dict[int, _Tile] = {}
        for t in starts:
            for old in [u for u in tiles if u < t]:
                del tiles[old]
            for u in starts[t // TILE :]:
                end = min(t + TILE, len(self.texts))
                if u >= self.ends[end - 1]:  # no block of this tile reaches so far
                    break
                if u > t and not self._adjacent(t, end, u):
                    continue
                for v in (t, u):
                    if v not in tiles:
                        tiles[v] = _Tile(self.texts[v : v + TILE])
                yield from self._near(t, u, tiles[t], tiles[u])

    def _adjacent(self, t: int, end: int, u: int) -> bool:
        """Whether the block that goes on in tile u has lengths there that are adjacent to those in tile t."""
        start = max(t, int(np.searchsorted(self.block, self.block[u])))
        return start < end and self.sizes[u] - self.sizes[end - 1] <= 1

    def _near(self, t: int, u: int, a: _Tile, b: _Tile) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        together = self.block[t : t + TILE, None] == self.block[None, u : u + TILE]
        if t == u:
            together = np.triu(together, 1)
        if self.crossing[t : t + TILE].any():
            together &= ~self.crossing[t : t + TILE, None] | (self.own[t : t + TILE, None] != self.own[None, u : u + TILE])
        all_x, all_y = a.candidates(b, together)
        width = int(max(a.sizes.max(), b.sizes.max())) + 1
        for k in range(0, len(all_x), BATCH):
            x, y = all_x[k : k + BATCH], all_y[k : k + BATCH]
            if a.letters is None or b.letters is None:
                good = np.fromiter((one_edit_apart(self.texts[t + p], self.texts[u + q]) for p, q in zip(x.tolist(), y.tolist())), bool, len(x))
            else:
                good = _one_edit_apart(a.letters[x, :width], b.letters[y, :width], a.sizes[x], b.sizes[y])
            x, y = x[good], y[good]
            if len(x):
                alike = a.counts[x] == b.counts[y]
                agree = np.stack([alike[:, GROUP_OF == g].all(1) for g in range(GROUPS)], axis=1)
                meets = np.stack([agree[:, list(choice)].all(1) for choice in CHOICES], axis=1)
                first = meets.argmax(1) == self.choice[t + x]
                yield t + x[first], u + y[first]


def _summed(rows: _Rows, n: np.ndarray) -> pa.RecordBatch | None:
    """One row for each word that has near words here: their number, the largest count and its word."""
    found = list(rows.pairs())
    if not found:
        return None
    x = np.concatenate([p for p, q in found] + [q for p, q in found])
    y = np.concatenate([q for p, q in found] + [p for p, q in found])
    most = np.zeros(len(n), np.int64)
    np.maximum.at(most, x, n[y])
    best: dict[int, str] = {}
    top = n[y] == most[x]
    for p, q in zip(x[top].tolist(), y[top].tolist()):
        word = rows.texts[q]
        if p not in best or word < best[p]:
            best[p] = word
    near = np.bincount(x, minlength=len(n))
    has = np.nonzero(near)[0]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows.texts[p] for p in has.tolist()], pa.string()), pa.nulls(len(has), pa.int64()), pa.array(near[has]),
            pa.StructArray.from_arrays([pa.array(-most[has]), pa.array([best[p] for p in has.tolist()], pa.string())], ["n", "word"]),
        ],
        names=["word", "n", "n_near", "best"],
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block and length; a block that a batch does not end waits for the next."""
    held: list[pa.RecordBatch] = []

    def solved(table: pa.Table) -> Iterator[pa.RecordBatch]:
        of = lambda c: table.column(c).to_numpy()
        rows = _Rows(of("choice"), of("key"), of("i"), of("j"), of("own"), table.column("word").to_pylist())
        out = _summed(rows, of("n"))
        if out is not None:
            yield out

    for batch in batches:
        if not batch.num_rows:
            continue
        names = ("choice", "key", "i", "j")
        ids = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names])
        last = (ids == ids[:, -1:]).all(0)
        start = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
        if held and start == 0 and all(held[-1].column(c)[-1] == batch.column(c)[0] for c in names):
            held.append(batch)
            continue
        if start == 0:
            if held:
                yield from solved(pa.Table.from_batches(held))
            held = [batch]
            continue
        yield from solved(pa.Table.from_batches([*held, batch.slice(0, start)]))
        held = [batch.slice(start)]
    if held:
        yield from solved(pa.Table.from_batches(held))


def _cells(keyed: DataFrame, block: int) -> DataFrame:
    """Rows with the cells (i, j) of their block; blocks of up to ``block`` words are one cell."""
    sizes = keyed.groupBy("choice", "key").agg(F.count("*").alias("size")).filter(F.col("size") > block)
    rows = keyed.join(sizes, ["choice", "key"], "left")
    cells = F.coalesce(F.ceil(F.col("size") / F.lit(block)), F.lit(1)).cast("int")
    rows = rows.withColumn("cells", cells).withColumn("own", F.pmod(F.xxhash64("word"), F.col("cells")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    return rows.select("choice", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "word", "n")


def near_words(counts: DataFrame, block: int | None = None) -> DataFrame:
    """word, n, n_near and best (its negative count and the word) for each row of ``counts`` (word, n)."""
    keyed = materialised(counts.select("word", "n").mapInArrow(_keyed, "choice int, key bigint, word string, n bigint"), "keyed")
    cells = _cells(keyed, block or BLOCK)
    dealt = cells.repartition("choice", "key", "i", "j").sortWithinPartitions("choice", "key", "i", "j", F.length("word"), "word")
    found = dealt.mapInArrow(_blocks, PARTIAL)
    none = counts.select("word", "n", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast("struct<n:bigint,word:string>").alias("best"))
    return none.unionAll(found).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def group_variants(counts: DataFrame, ratio: int = RATIO, block: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of ``counts`` (word, n; words are distinct)."""
    near = near_words(counts, block)
    likely = -F.col("best.n") >= F.col("n") * ratio
    formed = materialised(
        near.select("word", "n", "n_near", F.when(likely, F.col("best.word")).alias("form"), F.when(likely, -F.col("best.n")).alias("form_n")), "forms"
    )
    most = formed.agg(F.max("form_n")).first()[0] or 1
    steps = max(1, math.floor(math.log(most, ratio)) + 1)  # counts along a chain grow by the ratio
    ends = formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("end"))
    for _ in range(math.ceil(math.log2(steps))):
        onward = ends.select(F.col("word").alias("end"), F.col("end").alias("beyond"))
        ends = materialised(ends.join(onward, "end", "left").select("word", F.coalesce("beyond", "end").alias("end")), "ends")
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n")
