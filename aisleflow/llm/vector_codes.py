"""Vector codes: product quantisation in whole numbers, in rounds over Hilbert-sorted blocks.

Every component x becomes floor(SCALE * x); a vector is cut into PARTS equal parts. The parts
of one position are sorted along a Hilbert curve and cut into blocks of up to ``BLOCK``
points, each kept as one row: the points, the box around them (least and largest components)
and their sums. Blocks are written once and read in every round.

In a round, the distances of an entry to the nearest and to the farthest place of a box bound its
distances to all points of the block. An entry nearer to no point than the best farthest
distance is left out; the others are the block's shortlist. One entry alone takes the block
whole, by its sums; else a small kernel of whole numbers compares the points with the
shortlist. Ties go to the lower entry, also between bounds: an entry is left out only where
another one is strictly nearer to every point.

What leaves a task in a round is one sum and count per position and entry. The codebook (PARTS x
ENTRIES entries) is the only thing that reaches the driver.

Defined cases: vectors that are null, empty or hold a null or non-finite component have no
code and no row. The first codebook comes from the smallest vec_ids, repeated ones in order of their
components, null ids never; with fewer vectors than ENTRIES the codebook is as small as
they are many, and without a vector of non-null id there are no rows. Vectors whose length is not a
multiple of PARTS or differs from that of the first codebook vector cannot be cut like the
others and have no row. Components of any finite size are exact (beyond 64 bits in Python's
whole numbers); an error or label error that a long cannot hold is null. Repeated rows are
coded each. Entries without parts stay as they are. Other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from aisleflow.llm.common import materialised

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
BLOCK = 256
CURVE_BITS, MOST_BITS = 62, 8
SAFE = 2**62
BATCH_NUMBERS = 1 << 20

BLOCK_ROWS = "part int, wide boolean, d int, rows binary, points binary, low binary, high binary, sums binary"
SUM_ROWS = "part int, entry int, n bigint, total array<string>"


# --- rows to parts ------------------------------------------------------------


def _whole(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    """Parts of vectors: row, part, and its whole components as 64-bit numbers, or as text where they are wider."""
    most = max(1, BATCH_NUMBERS // (d * PARTS))
    for batch in (b.slice(k, most) for b in batches for k in range(0, b.num_rows, most)):
        rows = batch.column("_row").to_numpy(zero_copy_only=False)
        flat = np.floor(SCALE * batch.column("_vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(len(rows) * PARTS, d)
        wide = (np.abs(flat) >= 2**31).any(1)
        kept = np.where(wide[:, None], 0, flat).astype(np.int64)
        values = [kept[k].tobytes() if not w else ",".join(str(int(x)) for x in flat[k].tolist()).encode() for k, w in enumerate(wide.tolist())]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(rows, PARTS)), pa.array(np.tile(np.arange(PARTS, dtype=np.int32), len(rows))), pa.array(wide),
                pa.array(values, pa.binary()), pa.array(hilbert(np.clip(flat, -(2.0**30), 2.0**30))),
            ],
            names=["row", "part", "wide", "point", "curve"],
        )


def hilbert(points: np.ndarray) -> np.ndarray:
    """Place of each point on a Hilbert curve through its logarithmic grid; at most CURVE_BITS bits in all.

    Components beyond what the bits can hold do not take part: the order serves locality only.
    """
    used = points[:, : min(points.shape[1], CURVE_BITS)]
    n = used.shape[1]
    bits = max(1, min(MOST_BITS, CURVE_BITS // n))
    grid = np.sign(used) * np.log1p(np.abs(used)) / math.log1p(2.0**30)  # -1 to 1, fine near 0, where most components are
    x = [((grid[:, k] + 1) / 2 * (2**bits - 1)).round().astype(np.int64) for k in range(n)]
    q = 1 << (bits - 1)
    while q > 1:  # undo the turns and flips of each level
        low = q - 1
        for k in range(n):
            set_ = (x[k] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[k]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            if k:
                x[k] = x[k] ^ swap
        q >>= 1
    for k in range(1, n):
        x[k] = x[k] ^ x[k - 1]
    turn, q = np.zeros(len(points), np.int64), 1 << (bits - 1)
    while q > 1:
        turn = np.where(x[n - 1] & q, turn ^ (q - 1), turn)
        q >>= 1
    place = np.zeros(len(points), np.int64)
    for bit in range(bits - 1, -1, -1):
        for k in range(n):
            place = (place << 1) | (((x[k] ^ turn) >> bit) & 1)
    return place


# --- blocks -------------------------------------------------------------------


def _numbers(values: np.ndarray) -> bytes:
    """A vector of whole numbers as bytes; wide ones as text."""
    return ",".join(map(str, values.ravel().tolist())).encode() if values.dtype == object else values.tobytes()


def _read(data: bytes, wide: bool, d: int) -> np.ndarray:
    if not wide:
        return np.frombuffer(data, np.int64).reshape(-1, d)
    return np.array([int(x) for x in data.split(b",")], object).reshape(-1, d)


def _blocked(d: int):
    """Sorted parts as one row per block: equal position and width, neighbours on the curve."""

    def row(part: int, wide: bool, rows: list, values: list[bytes]):
        points = _read((b"," if wide else b"").join(values), wide, d)
        sums = _numbers(points.astype(object).sum(0))
        return part, wide, d, np.array(rows, np.int64).tobytes(), _numbers(points), _numbers(points.min(0)), _numbers(points.max(0)), sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kind = ([], []), None
        names = [f.split()[0] for f in BLOCK_ROWS.split(", ")]
        types = [pa.int32(), pa.bool_(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        for batch in batches:
            out = []
            for r, part, wide, point in zip(*(batch.column(c).to_pylist() for c in ("row", "part", "wide", "point"))):
                if kind != (part, wide) or len(held[0]) == BLOCK:
                    if held[0]:
                        out.append(row(*kind, *held))
                    held, kind = ([], []), (part, wide)
                held[0].append(r)
                held[1].append(point)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
        if held[0]:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row(*kind, *held), types)], names=names)

    return run


# --- rounds -------------------------------------------------------------------


def _fits(*arrays: np.ndarray) -> bool:
    """Whether squared distances between these whole numbers stay within 64 bits."""
    most = max(max(abs(int(a.max())), abs(int(a.min()))) if a.size else 0 for a in arrays)
    return (2 * most) ** 2 * max(a.shape[-1] for a in arrays) < SAFE


def shortlist(entries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Entries that may be nearest to some point of the box; of entries that tie everywhere all stay."""
    below, above = low - entries, entries - high
    nearest = np.maximum(np.maximum(below, above), 0 * below)
    farthest = np.maximum(np.abs(entries - low), np.abs(entries - high))
    return np.nonzero((nearest * nearest).sum(1) <= (farthest * farthest).sum(1).min())[0]


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entry nearest to each point (ties: the lower one) and the squared distance."""
    best, least = np.zeros(len(points), np.int64), None
    for k, entry in enumerate(entries):
        gap = points - entry
        apart = (gap * gap).sum(1)
        if least is None:
            least = apart
        else:
            closer = apart < least
            best[closer], least = k, np.where(closer, apart, least)
    return best, least


class _Block:
    def __init__(self, record: dict, codebook: list[np.ndarray]):
        self.part, wide, d = record["part"], record["wide"], record["d"]
        read = lambda c: _read(record[c], wide, d)
        entries, low, high = codebook[self.part], read("low")[0], read("high")[0]
        if wide or entries.dtype == object or not _fits(entries, low, high):
            entries, low, high = entries.astype(object), low.astype(object), high.astype(object)
        self.kind, self.record, self.wide, self.d = entries.dtype, record, wide, d
        self.short = shortlist(entries, low, high)
        self.entries = entries[self.short]

    def points(self) -> np.ndarray:
        return _read(self.record["points"], self.wide, self.d).astype(self.kind)

    def sums(self) -> Iterator[tuple[int, int, list[int]]]:
        """(entry, number of parts, their sums)."""
        if len(self.short) == 1:  # the whole block, without a look at its points
            yield int(self.short[0]), len(self.record["rows"]) // 8, [int(x) for x in self.record["sums"].split(b",")]
            return
        points = self.points()
        best, _ = nearest(points, self.entries)
        for k in np.unique(best).tolist():
            own = points[best == k].astype(object)
            yield int(self.short[k]), len(own), [int(x) for x in own.sum(0)]

    def codes(self) -> tuple[np.ndarray, np.ndarray]:
        best, least = nearest(self.points(), self.entries)
        return self.short[best], least


def _records(batch: pa.RecordBatch) -> Iterator[dict]:
    for k in range(batch.num_rows):
        yield {name: column[k].as_py() for name, column in zip(batch.schema.names, batch.columns)}


def _summed(codebook):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = defaultdict(int)
        totals: dict = {}
        for batch in batches:
            for record in _records(batch):
                block = _Block(record, codebook.value)
                for entry, n, total in block.sums():
                    key = block.part, entry
                    counts[key] += n
                    totals[key] = [a + b for a, b in zip(totals[key], total)] if key in totals else total
        keys = sorted(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _ in keys], pa.int32()), pa.array([e for _, e in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64()),
                pa.array([[str(x) for x in totals[k]] for k in keys], pa.list_(pa.string())),
            ],
            names=["part", "entry", "n", "total"],
        )

    return run


def _added(key: tuple, table: pa.Table) -> pa.Table:
    """The sums of the tasks for one position and entry added up."""
    totals = [[int(x) for x in t] for t in table.column("total").to_pylist()]
    return pa.table(
        {
            "part": pa.array([key[0].as_py()], pa.int32()), "entry": pa.array([key[1].as_py()], pa.int32()),
            "n": pa.array([sum(table.column("n").to_pylist())], pa.int64()),
            "total": pa.array([[str(sum(c)) for c in zip(*totals)]], pa.list_(pa.string())),
        }
    )


def _entries(values: list[list[int]]) -> np.ndarray:
    array = np.array(values, object)
    return array.astype(np.int64) if all(abs(x) < 2**62 for x in array.ravel().tolist()) else array


def _coded(codebook):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for record in _records(batch):
                codes, least = _Block(record, codebook.value).codes()
                rows = np.frombuffer(record["rows"], np.int64)
                fits = least.dtype != object
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows), pa.array(np.full(len(rows), record["part"], np.int32)), pa.array(codes.astype(np.int32)),
                        pa.array(least if fits else [int(x) if int(x) < 2**63 else None for x in least], pa.int64()),
                    ],
                    names=["row", "part", "entry", "error"],
                )

    return run


# --- the operator -------------------------------------------------------------


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that can be coded at all, as (vec_id, label, _vector, _row) with a row number that stays."""
    whole = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & (F.size("embedding") % PARTS == 0)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.filter(whole & F.coalesce(finite, F.lit(False)))
    return materialised(kept.select("vec_id", "label", F.col("embedding").alias("_vector"), F.monotonically_increasing_id().alias("_row")), "vectors")


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) of every vector that can be cut, and the codebook of each part."""
    spark = vectors.sparkSession
    kept = usable(vectors)
    first = kept.filter(F.col("vec_id").isNotNull()).orderBy("vec_id", "_vector").limit(ENTRIES).select("_vector").collect()
    fields = [kept.schema["vec_id"], kept.schema["label"], StructField("code", StringType())]
    if not first:
        return spark.createDataFrame([], StructType(fields)).withColumn("error", F.lit(None).cast("bigint")), []
    length = len(first[0]["_vector"])
    d = length // PARTS
    scaled = [[math.floor(SCALE * x) for x in r["_vector"]] for r in first if len(r["_vector"]) == length]
    codebook = [_entries([v[p * d : (p + 1) * d] for v in scaled]) for p in range(PARTS)]

    kept = kept.filter(F.size("_vector") == length)
    parts = kept.select("_row", "_vector").mapInArrow(lambda b: _whole(b, d), "row bigint, part int, wide boolean, point binary, curve bigint")
    # The hash lets equal points go to several tasks; the order within one place does not matter.
    order = ["part", "wide", "curve", F.xxhash64("row")]
    blocks = materialised(parts.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocked(d), BLOCK_ROWS), "blocks")
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(codebook)
        sums = blocks.mapInArrow(_summed(sent), SUM_ROWS).groupBy("part", "entry").applyInArrow(_added, SUM_ROWS).collect()
        for row in sums:  # at most PARTS * ENTRIES rows
            moved = codebook[row.part].astype(object)
            moved[row.entry] = [int(x) // row.n for x in row.total]
            codebook[row.part] = _entries(moved.tolist())
    sent = spark.sparkContext.broadcast(codebook)
    pieces = F.array_sort(F.collect_list(F.struct("part", "entry")))
    hexes = F.transform(pieces, lambda p: F.lower(F.lpad(F.hex(p["entry"]), 2, "0")))
    error = F.when(F.count("error") == PARTS, F.try_sum("error")).alias("error")
    codes = blocks.mapInArrow(_coded(sent), "row bigint, part int, entry int, error bigint").groupBy("row").agg(F.array_join(hexes, "").alias("code"), error)
    return kept.join(codes, kept["_row"] == codes["row"]).select("vec_id", "label", "code", "error"), codebook


def codebook_digest(codebook: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and position, as decimal numbers between commas."""
    return hashlib.sha256(",".join(str(int(x)) for entries in codebook for x in entries.ravel()).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with the error summed over equal labels; null labels are one."""
    coded = materialised(coded, "codes")
    whole = F.when(F.count("error") == F.count("*"), F.sum(F.col("error").cast("decimal(38,0)")))
    sums = coded.groupBy(F.col("label").alias("_label")).agg(whole.try_cast("bigint").alias("label_error"))
    return coded.join(sums, coded["label"].eqNullSafe(sums["_label"])).drop("_label")
