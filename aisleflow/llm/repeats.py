"""Repeated passages found by suffix sorting with a difference cover.

A byte goes if it lies in a string of ``WIDTH`` bytes that also starts in a
document with a smaller id. Texts are bytes and matches stay within documents.

How suffixes are distributed. Windows of WIDTH bytes are dealt by the smallest
hash of the 16-byte strings in them, which equal windows share; neighbouring
windows with the same one travel as one piece of text. A first exchange, of
hashes only, settles all pieces whose hash no second document has. Pieces that
are left are made unique per chunk of documents and per part, with the smallest
id that holds them. A piece that is alone with its hash in the whole table is
settled too: its windows are where it is.

How a part sorts the suffixes of its other pieces. Letters are 8 bytes; the
difference cover {1, 2} modulo 3 samples letters. Letters are ranked. Sampled
triples of letters (24 bytes) are sorted and named, the recursion sorts the names
(it ends after one step, as two names and two bytes are WIDTH bytes), the
remaining suffixes are merged in by their first letters and the rank of the
sampled suffix behind, and neighbours in the order are compared on their
prefixes. Each group of equal prefixes takes the smallest document id in it. The
hashes of a part are sorted ``SORT_BYTES`` at a time, so that the arrays of a
sort stay in the processor's cache.

How a hot hash is split. Where the distinct pieces of one hash take more than
``HOT_BYTES`` (a common line with many different neighbours), its windows are
dealt anew: the first place of the hash in a window cuts windows into runs of up
to ``STEP``, and each run goes to the part of a hash of the bytes that all windows
with that cut share. Equal windows have the same cut and the same bytes, so they
still meet. What is still hot is dealt window by window, by a hash of all its
bytes; then a hash has one window per chunk.

At scale nothing is larger than a chunk or a part, whose sizes are fixed, times
what pieces repeat: a piece comes once per chunk however many documents hold it.

Defined cases: null is the empty text; a document with a null id neither loses
bytes nor makes others lose them; documents with equal ids do not affect each
other; rows are kept as often as they come, with all their columns. doc_id has
to be a whole number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from aisleflow.llm.common import U64, bucketed, materialised, mixed, sliding, work_groups

WIDTH = 50
ANCHOR = 16
CHUNK_BYTES = 8_000_000
PART_BYTES = 8_000_000
HOT_BYTES = 4_000_000
BLOCK = 1 << 17
SORT_BYTES = 1 << 16
LIST_PIECES = 1 << 16
STEP = 8
NO_ID = np.iinfo(np.int64).max
OWN = ("rep_kept", "rep_bytes", "rep_removed", "rep_spans")


_compressor, _decompressor = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def packed(data: bytes) -> bytes:
    return _compressor.compress(data)


def unpacked(data: bytes) -> bytes:
    return _decompressor.decompress(data)


def _together(*columns: np.ndarray) -> bytes:
    """Columns of the same length as one value."""
    return packed(b"".join(x.tobytes() for x in columns))


def _apart(data: bytes, *kinds: type) -> list[np.ndarray]:
    """The columns of ``_together``."""
    data = unpacked(data)
    sizes = [np.dtype(kind).itemsize for kind in kinds]
    n = len(data) // sum(sizes)
    return [np.frombuffer(data, kind, n, n * sum(sizes[:k])) for k, kind in enumerate(kinds)]


def letters(buffer: bytes) -> np.ndarray:
    """The 8 bytes at every offset as one number, first byte first; zeros follow the end."""
    padded = buffer + bytes(96 - len(buffer) % 8)
    out = np.empty(len(padded) - 8, U64)
    for k in range(8):
        whole = (len(padded) - k) // 8
        own = np.frombuffer(padded, ">u8", whole, k)
        span = out[k::8]
        span[:] = own[: len(span)]
    return out


def pieces(buffer: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows, hash and text of each piece of texts laid end to end, block by block."""
    ends = np.cumsum(lengths)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64))]
    for block in range(0, len(buffer) - WIDTH + 1, BLOCK):
        part = buffer[block : block + BLOCK + WIDTH - 1]
        word = letters(part)
        count = len(part) - ANCHOR + 1
        lowest = sliding(mixed(word[:count] * U64(0x9E3779B97F4A7C15) + word[8 : 8 + count]), WIDTH - ANCHOR + 1, np.minimum)
        new = np.empty(len(lowest), bool)
        new[0] = True
        np.not_equal(lowest[1:], lowest[:-1], out=new[1:])
        borders = ends[np.searchsorted(ends, block) : np.searchsorted(ends, block + len(part))] - block
        new[borders[borders < len(new)]] = True
        start = np.flatnonzero(new)
        stop = np.append(start[1:], len(new))
        found.append((start + block, stop - start, lowest[start]))
    start, n, value = (np.concatenate(x) for x in zip(*found))
    text = np.repeat(np.arange(len(ends)), np.diff(np.searchsorted(start, ends), prepend=0))
    n = np.minimum(n, ends[np.minimum(text, len(ends) - 1)] - WIDTH + 1 - start) if len(ends) else n
    inside = n > 0  # windows that reach into the next text are none
    return start[inside], n[inside], value[inside], text[inside]


def _ranks(key: np.ndarray) -> np.ndarray:
    """The dense rank of each item, from 0."""
    order = np.argsort(key)
    own = key[order]
    rank = np.zeros(len(key), np.int64)
    rank[order[1:]] = np.cumsum(own[1:] != own[:-1])
    return rank


def _joined(*keys: np.ndarray) -> np.ndarray:
    """One number for several whole numbers from 0, in the same order, the first most important."""
    out, bits = keys[0], int(keys[0].max(initial=0)).bit_length()
    for key in keys[1:]:
        more = int(key.max(initial=0)).bit_length()
        if bits + more > 63:
            out = _ranks(out)
            bits = int(out.max(initial=0)).bit_length()
        out, bits = out << more | key, bits + more
    return out


def _below(place: np.ndarray, size: int) -> np.ndarray:
    """For each of ``size`` places how many items have a smaller one."""
    count = np.bincount(place, minlength=size)
    return np.cumsum(count) - count


def prefix_groups(buffer: bytes, starts: np.ndarray) -> np.ndarray:
    """A number for each suffix start, equal if the first WIDTH bytes are, in order of the suffixes.

    Difference-cover suffix sorting; ``starts`` are in increasing order and have
    WIDTH bytes behind them. Letters are ranked once, so that every key of a
    sort is one number.
    """
    word = letters(buffer)
    letter = _ranks(word)
    wanted = np.zeros(len(word), bool)
    for k in (0, 8, 16):
        wanted[starts + k] = True
    at = np.flatnonzero(wanted)
    sampled_at = at[at // 8 % 3 > 0]
    wanted[:] = False
    wanted[sampled_at] = wanted[sampled_at + 24] = True
    named_at = np.flatnonzero(wanted)
    # Sort sampled triples of letters and name them.
    name = np.zeros(len(word), np.int64)
    name[named_at] = _ranks(_joined(letter[named_at], letter[named_at + 8], letter[named_at + 16]))
    # Recurse on the names: two of them and the next two bytes are WIDTH bytes.
    key = _joined(name[sampled_at], name[sampled_at + 24], (word[sampled_at + 48] >> U64(48)).astype(np.int64))
    order = np.argsort(key)
    sorted_at, key = sampled_at[order], key[order]
    differs = lambda x: x[1:] != x[:-1]
    place = np.zeros(len(word), np.int64)
    place[sorted_at[1:]] = np.cumsum(differs(key))
    depth, new = {}, differs(name[sorted_at]) | differs(letter[sorted_at + 24])
    for width, more in ((WIDTH - 16, [26]), (WIDTH - 8, [32, 34])):
        longer = new.copy()
        for k in more:
            longer |= differs(letter[sorted_at + k])
        depth[width] = np.zeros(len(word), np.int64)
        depth[width][sorted_at[1:]] = np.cumsum(longer)
    # Merge the remaining suffixes: against class 1 by one letter, against class 2 by two, and the rank behind.
    kind = starts // 8 % 3
    smaller = np.zeros(len(starts), np.int64)
    rest = np.flatnonzero(kind == 0)
    for other, width in ((1, WIDTH - 8), (2, WIDTH - 16)):
        both = np.concatenate([rest, np.flatnonzero(kind == other)])
        at = starts[both]
        rank = _ranks(_joined(*(letter[at + k] for k in range(0, WIDTH - width, 8)), depth[width][at + WIDTH - width]))
        of_rest, of_other = rank[: len(rest)], rank[len(rest) :]
        rest_before, other_before = _below(of_rest, len(rank)), _below(of_other, len(rank))
        # A remaining suffix counts the smaller sampled ones, a sampled suffix the smaller remaining ones.
        smaller[rest] += other_before[of_rest]
        if other == 1:
            smaller[rest] += rest_before[of_rest]
        smaller[both[len(rest) :]] += rest_before[of_other]
    own = np.flatnonzero(kind > 0)
    at = place[starts[own]]
    smaller[own] += _below(at, len(word))[at]
    return smaller


def _flat(counts: np.ndarray, starts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of chosen items that have ``counts`` entries from ``starts`` on: how many each has, and the places of all entries."""
    times = counts[chosen]
    ends = np.cumsum(times, dtype=np.int64)
    return times, np.repeat(starts[chosen] - ends + times, times) + np.arange(ends[-1] if len(ends) else 0)


def _solve(texts: list[bytes], hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """How many runs of windows each distinct piece has, and starts, ends and smallest ids of the runs."""
    windows = np.fromiter(map(len, texts), np.int64, len(texts)) - WIDTH + 1
    _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    is_shared = counts[inverse] > 1
    shared = np.flatnonzero(is_shared)
    shared = shared[np.argsort(inverse[shared], kind="stable")]
    cuts = np.flatnonzero(np.diff(inverse[shared], prepend=-1))  # all pieces of a hash are sorted together
    sizes = np.add.reduceat(windows[shared] + WIDTH - 1, cuts) if len(cuts) else cuts
    alone = np.flatnonzero(~is_shared)
    found = [(alone, np.ones(len(alone), np.int64), np.zeros(len(alone), np.int64), windows[alone], ids[alone])]
    for a, b in work_groups(sizes.tolist(), SORT_BYTES):
        chosen = shared[cuts[a] : cuts[b] if b < len(cuts) else None]
        found.append((chosen, *_sort_together([texts[i] for i in chosen.tolist()], windows[chosen], ids[chosen])))
    piece, n, *runs = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(piece)
    _, at = _flat(n, np.cumsum(n) - n, order)
    return n[order], *(x[at] for x in runs)


def _sort_together(texts: list[bytes], windows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number, starts, ends and smallest ids of the runs of pieces whose windows are sorted together."""
    first = np.cumsum(windows) - windows
    piece = np.repeat(np.arange(len(windows)), windows)
    group = prefix_groups(b"".join(texts), np.arange(len(piece)) + piece * (WIDTH - 1))
    smallest = np.full(len(piece), NO_ID)
    np.minimum.at(smallest, group, ids[piece])
    least = smallest[group]
    new = np.ones(len(piece), bool)
    new[1:] = (least[1:] != least[:-1]) | (piece[1:] != piece[:-1])
    cut = np.flatnonzero(new)
    own = piece[cut]
    return np.bincount(own, minlength=len(windows)), cut - first[own], np.append(cut[1:], len(piece)) - first[own], least[cut]


def _chunks(batches):
    for batch in batches:
        texts = batch.column(batch.schema.names.index("text")).cast(pa.binary())
        rest = batch.drop_columns(["text"])
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        for a, b in work_groups(sizes, CHUNK_BYTES):
            part = rest.slice(a, b - a)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema) as writer:
                writer.write_batch(part)
            ids = pc.fill_null(part.column(part.schema.names.index("doc_id")).cast(pa.int64()), NO_ID).to_numpy()
            yield pa.RecordBatch.from_pydict(
                {
                    "ids": [ids.tobytes()],
                    "lengths": [np.array(sizes[a:b], np.int64).tobytes()],
                    "size": pa.array([sum(sizes[a:b])], pa.int64()),
                    "text": [packed(b"".join(t or b"" for t in texts.slice(a, b - a).to_pylist()))],
                    "rest": [packed(sink.getvalue().to_pybytes())],
                }
            )


def _own_pieces(row: dict) -> tuple:
    """Text, ids and pieces of a chunk; documents without an id have none."""
    buffer, ids, lengths = unpacked(row["text"]), np.frombuffer(row["ids"], np.int64), np.frombuffer(row["lengths"], np.int64)
    start, n, value, text = pieces(buffer, lengths)
    known = ids[text] != NO_ID
    return buffer, ids, lengths, start[known], n[known], value[known], text[known]


def _by_part(values: np.ndarray, parts: int) -> list[tuple[int, np.ndarray]]:
    part = (values % U64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)  # two bytes are sorted by counting
    order = np.argsort(part, kind="stable")
    cut = np.flatnonzero(np.diff(part[order].astype(np.int64), prepend=-1))
    return [(int(part[o[0]]), o) for o in np.split(order, cut[1:])] if len(order) else []


def _sorted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of values, and where in it each distinct one begins."""
    order = np.argsort(values)
    own = values[order]
    new = np.ones(len(own), bool)
    new[1:] = own[1:] != own[:-1]
    return order, np.flatnonzero(new)


def _hash_lists(parts: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                _, _, _, _, _, value, text = _own_pieces(row)
                order, new = _sorted(value)
                distinct, owner = value[order[new]], text[order]
                several = np.minimum.reduceat(owner, new) != np.maximum.reduceat(owner, new) if len(new) else new
                lists = _by_part(distinct, parts)
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([p for p, _ in lists], pa.int64()),
                        "chunk": pa.array([row["chunk"]] * len(lists), pa.int64()),
                        "hashes": pa.array([(distinct[o] >> U64(32)).astype(np.uint32).tobytes() for _, o in lists], pa.binary()),
                        "several": pa.array([np.packbits(several[o]).tobytes() for _, o in lists], pa.binary()),
                    }
                )

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """Which hashes of each list more than one document has. Half a hash tells as much in a part of fixed size."""
    lists = [np.frombuffer(h, np.uint32) for h in table.column("hashes").to_pylist()]
    flags = [np.unpackbits(np.frombuffer(s, np.uint8), count=len(h)) for s, h in zip(table.column("several").to_pylist(), lists)]
    distinct, inverse, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    again = counts > 1
    again[inverse[np.concatenate(flags) > 0]] = True
    bits = np.split(again[inverse], np.cumsum([len(h) for h in lists])[:-1])
    return pa.table({"chunk": table.column("chunk"), "part": table.column("part"), "again": pa.array([np.packbits(b).tobytes() for b in bits], pa.binary())})


def _listed(buffer: bytes, start: np.ndarray, n: np.ndarray, value: np.ndarray, ids: np.ndarray, owner: np.ndarray, offset: np.ndarray, parts: int):
    """The pieces of a chunk by part, equal ones once with their smallest id, and where they are; before them the most bytes of one hash."""
    lists = _by_part(value, parts)
    for a, b in work_groups([len(o) for _, o in lists], LIST_PIECES):
        o = np.concatenate([o for _, o in lists[a:b]])
        number: dict[bytes, int] = {}
        occurrence = [number.setdefault(buffer[s : s + k], len(number)) for s, k in zip(start[o].tolist(), (n[o] + WIDTH - 1).tolist())]
        occurrence = np.array(occurrence, np.int32)
        least = np.full(len(number), NO_ID)
        np.minimum.at(least, occurrence, ids[o])
        values = np.empty(len(number), U64)
        values[occurrence] = value[o]
        sizes = np.fromiter(map(len, number), np.int32, len(number))
        of_hash, (order, new) = np.empty(len(number), np.int64), _sorted(values)
        of_hash[order] = np.repeat(np.add.reduceat(sizes[order], new, dtype=np.int64), np.diff(new, append=len(order)))
        owners, offsets = owner[o].astype(np.int32), offset[o].astype(np.int32)
        # Equal pieces are of one part, so those of a part have neighbouring numbers.
        stop = np.cumsum([len(o) for _, o in lists[a:b]])
        known = np.maximum.accumulate(occurrence)[stop - 1] + 1
        texts, at, u = list(number), 0, 0
        for (p, _), end, v in zip(lists[a:b], stop.tolist(), known.tolist()):
            heads = _together(values[u:v], sizes[u:v], least[u:v])
            places = _together(occurrence[at:end] - np.int32(u), owners[at:end], offsets[at:end])
            yield p, int(of_hash[u:v].max()), heads, packed(b"".join(texts[u:v])), places
            at, u = end, v


def _lists_table(chunk: int, lists) -> pa.Table:
    """Rows of the lists of a chunk."""
    part, most, *columns = [*zip(*lists)] or [()] * 5
    return pa.table(
        {"part": pa.array(part, pa.int64()), "chunk": pa.array([chunk] * len(part), pa.int64()), "most": pa.array(most, pa.int64())}
        | {name: pa.array(data, pa.binary()) for name, data in zip(("heads", "texts", "places"), columns)}
    )


PIECES = "part long, chunk long, most long, heads binary, texts binary, places binary"


def _piece_lists(parts: int):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row in chunk.to_pylist():
            buffer, ids, lengths, start, n, value, text = _own_pieces(row)
            begin = np.cumsum(lengths) - lengths
            order, new = _sorted(value)
            distinct, again = value[order[new]], np.zeros(len(new), bool)
            bits = dict(zip(answers.column("part").to_pylist(), answers.column("again").to_pylist()))
            for p, o in _by_part(distinct, parts):
                again[o] = np.unpackbits(np.frombuffer(bits[p], np.uint8), count=len(o)) > 0
            kept = np.empty(len(value), bool)
            kept[order] = np.repeat(again, np.diff(new, append=len(value)))
            start, n, value, text = start[kept], n[kept], value[kept], text[kept]
            out.append(_lists_table(row["chunk"], _listed(buffer, start, n, value, ids[text], text, start - begin[text], parts)))
        return pa.concat_tables(out)

    return run


def _large(least: int):
    """Bytes of the distinct pieces of each hash in a list, where they are not below ``least``."""

    def run(batches):
        for batch in batches:
            for heads in batch.column("heads").to_pylist():
                values, sizes, _ = _apart(heads, U64, np.int32, np.int64)
                order, new = _sorted(values)
                size = np.add.reduceat(sizes[order], new, dtype=np.int64)
                large = size >= least
                yield pa.RecordBatch.from_pydict({"value": values[order[new[large]]].view(np.int64), "size": size[large]})

    return run


def _hot(lists: DataFrame, chunks: int, most: int) -> np.ndarray:
    """Hashes whose pieces may take more than ``most`` bytes in all lists; all that do are among them.

    What a chunk leaves out of the sum is less than half of ``most`` over all chunks.
    """
    least = most // (2 * max(chunks, 1))
    large = lists.filter(F.col("most") >= least).select("heads").mapInArrow(_large(least), "value long, size long")
    rows = large.groupBy("value").agg(F.sum("size").alias("size")).filter(F.col("size") > most // 2).select("value").collect()
    return np.sort(np.array([r.value for r in rows], np.int64).view(U64))


def _cut_again(text: bytes, sizes: np.ndarray, values: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows, new hash and old piece of the runs of up to ``step`` windows of pieces laid end to end."""
    windows = sizes.astype(np.int64) - WIDTH + 1
    piece = np.repeat(np.arange(len(sizes)), windows)
    begin = np.cumsum(sizes, dtype=np.int64) - sizes
    s = np.arange(len(piece)) + np.repeat(begin - np.cumsum(windows) + windows, windows)
    word, at = letters(text), s
    if step > 1:
        count = len(text) - ANCHOR + 1
        here = mixed(word[:count] * U64(0x9E3779B97F4A7C15) + word[8 : 8 + count]) == np.repeat(values, sizes)[:count]
        anchor = np.minimum.accumulate(np.where(here, np.arange(count), len(text))[::-1])[::-1][s]
        at = anchor - (anchor - s) // step * step
    first = np.flatnonzero((np.diff(piece, prepend=-1) != 0) | (np.diff(at, prepend=-1) != 0))
    shared = WIDTH - step + 1  # bytes from ``at`` on that are in each of the windows cut there
    value, place = values[piece[first]], at[first]
    for k in [*range(0, shared - 7, 8), shared - 8]:
        value = mixed(value * U64(31) + word[place + k])
    return s[first], np.diff(np.append(first, len(s))), value, piece[first]


def _split(hot: np.ndarray, step: int, parts: int, rest: bool):
    """Lists of the pieces of hot hashes cut again, or (``rest``) lists without those pieces."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                text, (values, sizes, least) = unpacked(row["texts"]), _apart(row["heads"], U64, np.int32, np.int64)
                occurrence, owner, offset = _apart(row["places"], np.int32, np.int32, np.int32)
                chosen = np.isin(values, hot) != rest
                begin = np.cumsum(sizes, dtype=np.int64) - sizes
                text = b"".join(text[a : a + k] for a, k in zip(begin[chosen].tolist(), sizes[chosen].tolist()))
                sizes, values, least = sizes[chosen], values[chosen], least[chosen]
                if not len(sizes):
                    continue
                begin = np.cumsum(sizes, dtype=np.int64) - sizes
                inside = chosen[occurrence]
                occurrence, owner, offset = (np.cumsum(chosen) - 1)[occurrence[inside]], owner[inside], offset[inside]
                if rest:
                    start, n, value, piece = begin, sizes.astype(np.int64) - WIDTH + 1, values, np.arange(len(sizes))
                else:
                    start, n, value, piece = _cut_again(text, sizes, values, step)
                counts = np.bincount(piece, minlength=len(sizes))
                times, run_at = _flat(counts, np.cumsum(counts) - counts, occurrence)
                own = np.repeat(np.arange(len(occurrence)), times)
                of = occurrence[own]
                lists = _listed(text, start[run_at], n[run_at], value[run_at], least[of], owner[own], offset[own] + start[run_at] - begin[of], parts)
                yield from _lists_table(row["chunk"], lists).to_batches()

    return run


def _without_hot(lists: DataFrame, chunks: int, parts: int, most: int) -> DataFrame:
    """The lists, with the pieces of hot hashes dealt anew. ``list`` numbers them."""
    numbered = lambda df, k, purpose: materialised(df.withColumn("list", F.monotonically_increasing_id() * 8 + k), purpose)
    now, done = numbered(lists, 0, "piece-lists"), []
    for k, step in enumerate((STEP, 1)):
        hot = _hot(now, chunks, most)
        if not len(hot):
            break
        there = F.col("part").isin(np.unique(hot % U64(parts)).tolist())
        whole = now.filter(there).select(*[name.split()[0] for name in PIECES.split(", ")])
        done.append(now.filter(~there))
        done.append(numbered(whole.mapInArrow(_split(hot, step, parts, True), PIECES), 2 * k + 1, "piece-lists"))
        now = numbered(whole.mapInArrow(_split(hot, step, parts, False), PIECES), 2 * k + 2, "piece-lists")
    for df in done:
        now = now.unionByName(df)
    return now


def _runs(table: pa.Table) -> pa.Table:
    """Sort the suffixes of a part; runs of windows with the smallest id that has them, for each list of pieces."""
    number: dict[bytes, int] = {}
    rows, values, ids = [], [], []
    for row in table.to_pylist():
        value, sizes, least = _apart(row["heads"], U64, np.int32, np.int64)
        text, at, own = unpacked(row["texts"]), 0, []
        for size in sizes.tolist():
            own.append(number.setdefault(text[at : at + size], len(number)))
            at += size
        rows.append(np.array(own, np.int64))
        values.append(value)
        ids.append(least)
    every = np.concatenate(rows)
    least, value = np.full(len(number), NO_ID), np.empty(len(number), U64)
    np.minimum.at(least, every, np.concatenate(ids))
    value[every] = np.concatenate(values)
    counts, *runs = _solve(list(number), value, least)
    times, at = _flat(counts, np.cumsum(counts) - counts, every)
    times = times.astype(np.int32)
    first, last, smallest = runs[0][at].astype(np.int32), runs[1][at].astype(np.int32), runs[2][at]
    stop = np.cumsum([len(own) for own in rows])
    found, a, u = [], 0, 0
    for b, v in zip(stop.tolist(), np.cumsum(times, dtype=np.int64)[stop - 1].tolist()):
        found.append(packed(b"".join(x.tobytes() for x in (times[a:b], first[u:v], last[u:v], smallest[u:v]))))
        a, u = b, v
    return pa.table({"list": table.column("list"), "chunk": table.column("chunk"), "runs": pa.array(found, pa.binary())})


def _cut_texts(chunk: pa.Table, found: pa.Table) -> pa.Table:
    """Like ``_cut``, with what is left as text; a character that lost a byte goes."""
    table = _cut(chunk, found)
    k = table.column_names.index("rep_kept")
    texts = [b.decode("utf-8", "ignore") for b in table.column(k).to_pylist()]
    return table.set_column(k, "rep_kept", pa.array(texts, pa.string()))


def _windows_gone(found: pa.Table, ids: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of windows in a chunk that a smaller id has."""
    runs, places = ({k: x for k, x in zip(found.column("list").to_pylist(), found.column(name).to_pylist()) if x} for name in ("runs", "places"))
    columns, base = [], 0
    for k, where in places.items():
        occurrence, owner, offset = _apart(where, np.int32, np.int32, np.int32)
        data, n = unpacked(runs.pop(k)), int(occurrence.max()) + 1
        total = (len(data) - 4 * n) // 16
        counts, first, last = np.split(np.frombuffer(data, np.int32, n + 2 * total), (n, n + total))
        columns.append((occurrence + base, owner, offset, counts, first, last, np.frombuffer(data, np.int64, total, 4 * n + 8 * total)))
        base += n
    if not columns:
        return begin[:0], begin[:0]
    occurrence, owner, offset, counts, first, last, least = (np.concatenate(x) for x in zip(*columns))
    times, at = _flat(counts, np.cumsum(counts, dtype=np.int64) - counts, occurrence)
    gone = least[at] < np.repeat(ids[owner], times)
    at, start = at[gone], np.repeat(begin[owner] + offset, times)[gone]
    return start + first[at], start + last[at]


def _cut(chunk: pa.Table, found: pa.Table) -> pa.Table:
    """The documents of a chunk without the windows of smaller ids."""
    tables = []
    for row in chunk.to_pylist():
        buffer, ids, lengths = unpacked(row["text"]), np.frombuffer(row["ids"], np.int64), np.frombuffer(row["lengths"], np.int64)
        begin = np.cumsum(lengths) - lengths
        change = np.zeros(len(buffer) + 1, np.int32)
        first, last = _windows_gone(found, ids, begin)
        np.add.at(change, first, 1)
        np.add.at(change, last + WIDTH - 1, -1)
        removed = np.cumsum(change, dtype=np.int32)[:-1] > 0
        opens = removed.copy()
        opens[1:] &= ~removed[:-1]
        opens[begin[lengths > 0]] = removed[begin[lengths > 0]]  # a run does not reach into the next text
        total, spans = (np.concatenate([np.zeros(1, np.int32), np.cumsum(x, dtype=np.int32)]) for x in (removed, opens))
        kept = np.frombuffer(buffer, np.uint8)[~removed].tobytes()
        n_removed = total[begin + lengths] - total[begin]
        at = np.concatenate([[0], np.cumsum(lengths - n_removed)]).tolist()
        rest = pa.ipc.open_stream(unpacked(row["rest"])).read_all()
        columns = {
            "rep_kept": pa.array([kept[a:b] for a, b in zip(at, at[1:])], pa.binary()),
            "rep_bytes": pa.array(lengths), "rep_removed": pa.array(n_removed, pa.int64()), "rep_spans": pa.array(spans[begin + lengths] - spans[begin], pa.int64()),
        }
        tables.append(pa.table({**{n: rest.column(n) for n in rest.column_names}, **columns}))
    return pa.concat_tables(tables)


def remove_repeats(docs: DataFrame, as_text: bool = False, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """All columns of the documents but text, and rep_kept (bytes left, or text), rep_bytes, rep_removed, rep_spans.

    Input columns of these names are replaced. A hash with more than ``hot_bytes`` of different pieces is split.
    """
    spark = docs.sparkSession
    docs = docs.drop(*OWN)
    chunks = bucketed(
        docs.mapInArrow(_chunks, "ids binary, lengths binary, size long, text binary, rest binary").withColumn(
            "chunk", F.monotonically_increasing_id()
        ),
        "text-chunks",
        "chunk",
    )
    size, n_chunks = chunks.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    named = chunks.select("chunk", "ids", "lengths", "text")
    again = (
        named.mapInArrow(_hash_lists(parts), "part long, chunk long, hashes binary, several binary")
        .groupBy("part")
        .applyInArrow(_repeated, "chunk long, part long, again binary")
    )
    lists = _without_hot(named.groupBy("chunk").cogroup(again.groupBy("chunk")).applyInArrow(_piece_lists(parts), PIECES), n_chunks, parts, hot_bytes)
    runs = lists.select("part", "list", "chunk", "heads", "texts").groupBy("part").applyInArrow(_runs, "list long, chunk long, runs binary")
    # Both halves of a list go straight to its chunk, so that no join moves them first.
    found = lists.select("list", "chunk", "places").unionByName(runs, allowMissingColumns=True)
    kept = StringType() if as_text else BinaryType()
    own = [StructField(name, kind) for name, kind in zip(OWN, (kept, LongType(), LongType(), LongType()))]
    return (
        chunks.select("chunk", "ids", "lengths", "text", "rest")
        .groupBy("chunk")
        .cogroup(found.groupBy("chunk"))
        .applyInArrow(_cut_texts if as_text else _cut, StructType([*docs.drop("text").schema, *own]))
    )
