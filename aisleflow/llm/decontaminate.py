"""Benchmark decontamination by winnowing.

Words are lower-cased runs of digits, letters a-z and non-ASCII characters. Of
each text the 5-word hashes are taken, and of each 6 neighbouring hashes the
smallest is kept, so two texts that share 10 words share a kept hash. Kept
hashes of documents and benchmark items are joined, and each pair they name is
checked word by word for every shared run of 10 words. An item of fewer words
is looked for whole: there every n-word hash is kept, n being its length.

At scale: a bitmap of fixed size drops, before the shuffle, nearly all document
hashes that no item has. It only saves work; the join decides, whatever the
size of the benchmark. Texts of documents without a kept hash in common are
neither shuffled nor read again.

Defined cases: a null or empty text has no words and is not contaminated; an
item without words hits nothing; rows with the same doc_id are judged each for
itself; rows of an item_id given twice are one item with the windows of both;
an item whose id is null hits words but is not counted or listed. Other columns
are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from aisleflow.llm.common import U64, WordHashes, materialised, mixed, rolling, sliding, work_groups

WINDOW = 10
GRAM = 5
KEPT_OF = WINDOW - GRAM + 1
FILTER_BITS = 24
BATCH_BYTES = 4_000_000
SEPARATORS = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words; bytes.lower changes A-Z only."""
    return (text or b"").lower().translate(SEPARATORS).split()


def winnowed(hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept 5-word hashes of texts laid end to end, and the text each belongs to."""
    grams = np.maximum(rolling(hashes, GRAM), U64(1))  # 0 marks windows that cross texts
    if len(grams) < KEPT_OF:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(lengths)), lengths)
    lowest = sliding(grams, KEPT_OF, np.minimum)
    within = text[: len(lowest)] == text[WINDOW - 1 : WINDOW - 1 + len(lowest)]
    lowest = np.where(within, lowest, U64(0))
    lowest = np.concatenate([np.zeros(KEPT_OF - 1, U64), lowest, np.zeros(KEPT_OF - 1, U64)])
    kept = np.flatnonzero(sliding(lowest, KEPT_OF, np.maximum) == grams)
    kept = kept[grams[kept] != 0]
    return grams[kept], text[kept]


def every_gram(hashes: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All n-word hashes of texts laid end to end, apart for each n, and the text of each."""
    grams = rolling(hashes, n)
    text = np.repeat(np.arange(len(lengths)), lengths)
    within = text[: len(grams)] == text[n - 1 : n - 1 + len(grams)]
    return mixed(grams[within] + U64(n)), text[: len(grams)][within]


def _fingerprints(texts: list[bytes | None], memo: WordHashes, short: list[int]):
    """Number of words of each text, kept hashes and the text of each."""
    words = [words_of(t) for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    hashes = np.concatenate([memo.of(w) for w in words] or [np.zeros(0, U64)])
    found = [winnowed(hashes, lengths), *(every_gram(hashes, lengths, n) for n in short)]
    return lengths, np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _document_rows(bits, short: list[int]):
    def run(batches):
        memo, bitmap = WordHashes(), bits.value
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for a, b in work_groups(sizes, BATCH_BYTES):
                part = texts.slice(a, b - a).to_pylist()
                lengths, grams, owner = _fingerprints(part, memo, short)
                slot = grams >> U64(64 - FILTER_BITS)
                hit = (bitmap[(slot >> U64(6)).astype(np.int64)] >> (slot & U64(63))) & U64(1) == U64(1)
                pairs = np.unique(np.stack([owner[hit].astype(U64), grams[hit]]), axis=1)
                counts = np.bincount(pairs[0].astype(np.int64), minlength=b - a)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(lengths),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(pairs[1].view(np.int64))),
                        pa.array([t if c else None for t, c in zip(part, counts)], pa.binary()),
                    ],
                    names=["doc_id", "n_words", "grams", "text"],
                )

    return run


def _item_rows(batches):
    memo = WordHashes()
    for batch in batches:
        for item, text in zip(batch.column("_item").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
            n = len(words_of(text))
            if not n:
                continue
            if n >= WINDOW:
                grams = _fingerprints([text], memo, [])[1]
            else:
                grams = every_gram(memo.of(words_of(text)), np.array([n]), n)[0]
            grams = np.unique(grams).view(np.int64)
            yield pa.RecordBatch.from_pydict(
                {"gram": pa.array(grams), "_item": pa.array([item] * len(grams), pa.int64()), "n": pa.array([min(n, WINDOW)] * len(grams), pa.int32())}
            )


def _hits(text: bytes, items: list[dict], memo: WordHashes) -> tuple[np.ndarray, set]:
    """Which words of a text lie in a window of an item, and the ids of items with such windows."""
    words = words_of(text)
    hashes = memo.of(words)
    covered = np.zeros(len(words) + 1, np.int64)
    named = set()
    windows: dict[int, dict[int, list]] = {}
    for item in items:
        other = words_of(item["text"])
        n = min(len(other), WINDOW)
        table = windows.setdefault(n, {})
        for j, h in enumerate(rolling(memo.of(other), n).tolist()):
            table.setdefault(h, []).append((item["item_id"], other[j : j + n]))
    for n, table in windows.items():
        grams = rolling(hashes, n)
        known = np.fromiter(table, U64, len(table))
        for i in np.flatnonzero(np.isin(grams, known)).tolist():
            same = [item for item, window in table[int(grams[i])] if window == words[i : i + n]]
            if same:
                covered[i] += 1
                covered[i + n] -= 1
                named.update(same)
    return np.cumsum(covered)[:-1] > 0, named


def _judged(batches):
    memo = WordHashes()
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            hit, named = _hits(row["text"], row["items"], memo) if row["items"] else (np.zeros(0, bool), set())
            out.append((row["doc_id"], row["n_words"], int(hit.sum()), sorted(str(i) for i in named if i is not None)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in out], batch.schema.field("doc_id").type),
                pa.array([r[1] for r in out], pa.int64()),
                pa.array([r[2] for r in out], pa.int64()),
                pa.array([r[3] for r in out], pa.list_(pa.string())),
            ],
            names=["doc_id", "n_words", "n_hit", "items"],
        )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit and the sorted ids (as text) of the items found in it."""
    spark = docs.sparkSession
    items = materialised(
        benchmark.select(F.monotonically_increasing_id().alias("_item"), "item_id", "text"), "benchmark"
    )
    grams = materialised(items.select("_item", "text").mapInArrow(_item_rows, "gram long, _item long, n int"), "item-grams")
    short = sorted(r.n for r in grams.select("n").distinct().collect() if r.n < WINDOW)
    slot = F.shiftrightunsigned("gram", 64 - FILTER_BITS)
    cells = (
        grams.groupBy(F.shiftright(slot, 6).alias("cell"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(gram, {64 - FILTER_BITS}) & 63 as int))")).alias("bits"))
        .collect()
    )  # at most 2**18 rows, whatever the benchmark holds
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for cell in cells:
        bitmap[cell.cell] = cell.bits
    kind = docs.schema["doc_id"].dataType.simpleString()
    seen = materialised(
        docs.select("doc_id", "text")
        .mapInArrow(
            _document_rows(spark.sparkContext.broadcast(bitmap.view(U64)), short),
            f"doc_id {kind}, n_words long, grams array<long>, text binary",
        )
        .withColumn("_row", F.monotonically_increasing_id()),
        "document-grams",
    )
    named = (
        seen.select("_row", F.explode("grams").alias("gram"))
        .join(grams.select("gram", "_item"), "gram")
        .select("_row", "_item")
        .distinct()
        .join(items, "_item")
        .groupBy("_row")
        .agg(F.collect_list(F.struct("item_id", F.col("text").cast("binary").alias("text"))).alias("items"))
    )
    return (
        seen.join(named, "_row", "left")
        .select("doc_id", "n_words", "text", "items")
        .mapInArrow(_judged, f"doc_id {kind}, n_words long, n_hit long, items array<string>")
    )
