"""Near-duplicate documents by Order MinHash.

A text is its 5-word shingles, each labelled with how often it came before, so
that all are different. A sketch takes the few shingles with the smallest hashes
under one seed and keeps them in text order; two texts agree in a sketch with a
probability that falls with each edit and each change of order. Texts that agree
in a sketch are candidates. A candidate pair is verified by aligning the two
shingle sequences within the band that a similarity of 0.8 allows: M is the
longest chain of equal shingles in the order of both, and M / (n + m - M) has to
be 0.8 or more.

Equal texts are one node from the start. In every bucket of equal sketches the
nodes are compared with its smallest node, not with each other. Where that leaves
more than one group of linked nodes in a bucket, the nodes outside the smallest
one's group are compared with each other and with that group in blocks of fixed
size, by counts of common shingles. So the links between different texts make the
same groups as all pairs would, and a bucket of near copies of its smallest node
costs one comparison per copy. Groups are connected
components by alternating star contraction.

Chance of missing a pair of similarity 0.8, by the shingles of its smaller text
(one sketch of k finds it with C(M, k) / C(n + m - M, k) or more): at most 3 in a
hundred million up to 30 shingles, 17 in ten million from 31 to 60, 12 in ten
million from 61 to 100, 9 in ten million above, and less for each further link of
its group. All texts get 36 sketches of 5 shingles. As 5 of few shingles are hard
to agree in, texts of at most 40 shingles get 12 of 4 as well and those of at most
16 another 16 of 2.

Defined cases: a null text is alone in its class; empty texts are equal texts;
a text without words equals only copies of itself; a text of fewer than five
words is one shingle; class_id is the smallest doc_id of the class (null if all
are null). One row is returned per input row. Other columns are not looked at.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from aisleflow.llm.common import U64, WordHashes, materialised, mixed, rolling, work_groups
from aisleflow.llm.decontaminate import words_of

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = ((36, 5, None), (12, 4, 40), (16, 2, 16))  # how many, of how many shingles, for texts of at most so many
BLOCK_NODES, BLOCK_CHARS, FEATURE_SLICE = 1024, 4_000_000, 2048
BATCH_BYTES = 4_000_000
SEEDS = mixed(np.arange(1, sum(n for n, _, _ in SKETCHES) + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the 5-word shingles of a text, each labelled with its occurrence."""
    if not len(hashes):
        return hashes
    grams = rolling(hashes, min(SHINGLE, len(hashes)))
    order = np.argsort(grams, kind="stable")
    ordered = grams[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    if new.all():
        return grams
    first = np.flatnonzero(new)
    occurrence = np.arange(len(grams)) - np.repeat(first, np.diff(np.append(first, len(grams))))
    out = np.empty_like(grams)
    out[order] = np.where(occurrence > 0, mixed(ordered + occurrence.astype(U64) * U64(0x632BE59BD9B4E019)), ordered)
    return out


def _ordered(grams: np.ndarray, seeds: np.ndarray, of: int) -> np.ndarray:
    """One sketch per seed: the ``of`` shingles of smallest hash, combined in text order."""
    size = len(grams)
    block = max(1, 2_000_000 // size)  # seeds at a time, so that long texts take no more memory
    places = U64((1 << size.bit_length()) - 1)  # the low bits of a rank say where the shingle is
    out = []
    for a in range(0, len(seeds), block):
        own = seeds[a : a + block]
        ranks = (grams[None, :] ^ own[:, None]) * U64(0xD6E8FEB86659FD93)
        ranks ^= ranks >> U64(32)
        ranks *= U64(0x9E3779B97F4A7C15)
        ranks &= ~places
        ranks |= np.arange(size, dtype=U64)
        kept = (np.partition(ranks, of - 1, axis=1)[:, :of] if size > of else ranks) & places
        kept.sort(axis=1)
        value = own.copy()
        for k in range(kept.shape[1]):
            value = mixed(value * U64(31) + grams[kept[:, k].astype(np.int64)])
        out.append(value)
    return np.concatenate(out)


def sketches(grams: np.ndarray) -> np.ndarray:
    if not len(grams):
        return np.zeros(0, U64)
    found, first = [], 0
    for n, of, most in SKETCHES:
        if most is None or len(grams) <= most:
            found.append(_ordered(grams, SEEDS[first : first + n], of))
        first += n
    return np.concatenate(found)


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """M / (n + m - M) of two sequences of distinct shingles; some value below ``least`` if it is below."""
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    band = int((1 - least) / (1 + least) * (n + m) + 1e-6)  # a chain of this similarity skips no more; whole numbers may come out a little below
    order = np.argsort(b, kind="stable")
    at = np.minimum(np.searchsorted(b[order], a), m - 1)
    j = order[at]
    i = np.arange(n)
    near = (b[j] == a) & (np.abs(i - j) <= band)
    j = j[near]
    if len(j) / (n + m - len(j)) < least:
        return 0.0
    if np.all(j[1:] > j[:-1]):
        return len(j) / (n + m - len(j))
    tails: list[int] = []
    for x in j.tolist():
        k = bisect_left(tails, x)
        tails[k : k + 1] = [x]
    return len(tails) / (n + m - len(tails))


def _sketched(batches):
    memo = WordHashes()
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        for a, b in work_groups(sizes, BATCH_BYTES):
            found = [sketches(shingles(memo.of(words_of(t)))).view(np.int64) for t in texts.slice(a, b - a).to_pylist()]
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("copy"), pa.array(found, pa.list_(pa.int64()))],
                names=["doc_id", "copy", "sketches"],
            )


def _compared(batches):
    memo = WordHashes()
    last, last_grams = None, None
    for batch in batches:
        alike = []
        for a, b, left, right in zip(
            batch.column("a").to_pylist(), batch.column("b"), batch.column("left").cast(pa.binary()), batch.column("right").cast(pa.binary())
        ):
            if a != last:  # neighbours often share the node compared with
                last, last_grams = a, shingles(memo.of(words_of(left.as_py())))
            alike.append(similarity(last_grams, shingles(memo.of(words_of(right.as_py())))) >= SIMILARITY)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(alike, pa.bool_())], names=["a", "b", "alike"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): root is the smallest node it is connected with."""

    def summary(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())

    now = materialised(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    while before != (before := summary(now)):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select("u", F.col("m").alias("v")).unionByName(joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        now = materialised(small.distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _linked_in_cell(table: pa.Table) -> pa.Table:
    """Links between the nodes of two blocks (or within one), as many as it takes to connect the groups they link."""
    texts, roots, nodes = table.column("text").cast(pa.binary()).to_pylist(), table.column("root").to_numpy(), table.column("node").to_numpy()
    first = table.column("block").to_numpy() == table.column("i").to_numpy()
    memo = WordHashes()
    grams = [shingles(memo.of(words_of(t))) for t in texts]
    sizes = np.array([len(g) for g in grams], np.float32)
    owner = np.repeat(np.arange(len(grams)), sizes.astype(np.int64))
    slot = np.unique(np.concatenate([*grams, np.zeros(0, U64)]), return_inverse=True)[1]
    order = np.argsort(slot, kind="stable")
    owner, slot = owner[order], slot[order]
    common = np.zeros((len(grams), len(grams)), np.float32)
    for c in range(0, int(slot[-1]) + 1 if len(slot) else 0, FEATURE_SLICE):
        a, b = np.searchsorted(slot, (c, c + FEATURE_SLICE))
        has = np.zeros((len(grams), FEATURE_SLICE), np.float32)
        has[owner[a:b], slot[a:b] - c] = 1
        common += has @ has.T
    union = np.maximum(sizes[:, None] + sizes[None, :] - common, 1)
    close = (common >= np.float32(SIMILARITY - 1e-4) * union) & (roots[:, None] != roots[None, :])
    same_block = table.column("i")[0] == table.column("j")[0] if len(grams) else True
    close &= np.tri(len(grams), k=-1, dtype=bool) if same_block else first[:, None] & ~first[None, :]
    group = {root: root for root in roots.tolist()}  # groups linked so far in this cell

    def find(root: int) -> int:
        while group[root] != root:
            group[root] = root = group[group[root]]
        return root

    found = []
    for x, y in np.argwhere(close).tolist():
        a, b = find(int(roots[x])), find(int(roots[y]))
        if a != b and similarity(grams[x], grams[y]) >= SIMILARITY:  # one link for each two groups is enough
            group[a] = b
            found.append((nodes[x], nodes[y]))
    return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})


def _more_links(shared: DataFrame, links: DataFrame, texts: DataFrame) -> DataFrame:
    """Links that the smallest nodes of the buckets do not have.

    Where a bucket is left with several groups, the nodes it shares with others
    of the same smallest node are dealt to blocks of fixed size, those outside
    that node's group apart from those in it. Each block outside meets every
    block; a group that is linked as a whole is not compared with itself.
    """
    rooted = components(links)
    rows = shared.join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key")
    of_hub = rooted.select(F.col("node").alias("a"), F.col("root").alias("hub_root"))
    members = materialised(
        rows.join(several, "key", "left_semi")
        .select("a", "node", "root")
        .distinct()
        .join(of_hub, "a", "left")
        .withColumn("outside", F.col("root") != F.coalesce("hub_root", "a"))
        .join(texts, "node")
        .select("a", "node", "root", "outside", "text"),
        "group-members",
    )
    blocks = lambda kind: F.greatest(
        F.ceil(F.count(F.when(kind, 1)) / BLOCK_NODES), F.ceil(F.sum(F.when(kind, F.length("text")).otherwise(0)) / BLOCK_CHARS)
    ).cast("int")
    counts = members.groupBy("a").agg(blocks(F.col("outside")).alias("n_out"), blocks(~F.col("outside")).alias("n_in"))
    # Stored, so that its size is known: while it is small it is broadcast, and a hub's members are not dealt by the hub.
    counts = materialised(counts.filter("n_out > 0"), "hub-blocks")
    h = F.xxhash64("node")
    block = F.when(F.col("outside"), F.pmod(h, F.col("n_out"))).otherwise(F.col("n_out") + F.pmod(h, F.col("n_in"))).cast("int")
    # A block outside meets all blocks, a block inside the blocks outside.
    others = F.sequence(F.lit(0), F.when(F.col("outside"), F.col("n_out") + F.col("n_in")).otherwise(F.col("n_out")) - 1)
    cells = (
        members.join(counts, "a")
        .withColumn("block", block)
        .withColumn("other", F.explode(others))
        .select("a", "node", "root", "text", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    )
    # Dealt by all three: the join's own partitioning by the hub would put its cells in one task.
    return cells.repartition("a", "i", "j").groupBy("a", "i", "j").applyInArrow(_linked_in_cell, "a long, b long")


def _links(nodes: DataFrame, buckets: DataFrame, docs: DataFrame) -> DataFrame | None:
    """Verified links between nodes of one bucket, enough to connect all that are linked; None without candidates."""
    centres = buckets.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("n")).filter("n > 1").select("key", "a")
    shared = materialised(buckets.join(centres, "key"), "shared-buckets")
    if shared.isEmpty():
        return None
    wanted = nodes.join(shared.select("node").distinct(), "node", "left_semi").select("node", "copy", "doc_id")
    texts = materialised(
        docs.select("doc_id", F.md5("text").alias("copy"), "text")
        .alias("d")
        .join(wanted.alias("c"), F.expr("d.copy = c.copy and d.doc_id <=> c.doc_id"))
        .groupBy("node")
        .agg(F.max("text").alias("text")),
        "candidate-texts",
    )
    links = materialised(
        shared.filter("node <> a")
        .select("a", F.col("node").alias("b"))
        .distinct()
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
        .join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a")
        .select("a", "b", "left", "right")
        .mapInArrow(_compared, "a long, b long, alike boolean")
        .filter("alike")
        .select("a", "b"),
        "links",
    )
    return links.unionByName(materialised(_more_links(shared, links, texts), "more-links"))


def _rooted(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, copy) of all texts that are not null; and of each distinct text copy, doc_id, n and the root of its class."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    seen = materialised(
        docs.filter("text is not null").select("doc_id", F.md5("text").alias("copy"), "text").mapInArrow(
            _sketched, f"doc_id {kind}, copy string, sketches array<long>"
        ),
        "sketches",
    )
    nodes = materialised(
        seen.groupBy("copy")
        .agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"), F.first("sketches").alias("sketches"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    links = _links(nodes, nodes.select("node", F.explode("sketches").alias("key")), docs)
    plain = nodes.select("node", "copy", "doc_id", "n")
    if links is None:
        return seen, plain.withColumn("root", F.col("node"))
    return seen, plain.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))


def classes(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, class_id (smallest doc_id of its class) and class_size in documents."""
    seen, rooted = _rooted(docs)
    named = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.sum("n").alias("class_size"))
    of_copy = rooted.select("copy", "root").join(named, "root").select("copy", "class_id", "class_size")
    alone = docs.filter("text is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return seen.select("doc_id", "copy").join(of_copy, "copy").select("doc_id", "class_id", "class_size").unionByName(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, as they are, one row of each class: of its smallest doc_id. Rows with null text stay."""
    rooted = _rooted(docs)[1]
    first = rooted.groupBy("root").agg(F.min_by("copy", F.struct(F.col("doc_id").isNull(), "doc_id", "copy")).alias("copy"))
    chosen = first.join(rooted.select("copy", "doc_id"), "copy").select(
        F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("\x00")), F.lit("\x01"), "copy")).alias("_key")
    )
    keyed = docs.filter("text is not null").withColumn(
        "_key", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("\x00")), F.lit("\x01"), F.md5("text")))
    )
    once = Window.partitionBy("_key").orderBy("_key")
    kept = keyed.join(chosen, "_key", "left_semi").withColumn("_n", F.row_number().over(once)).filter("_n = 1")
    return kept.select(docs.columns).unionByName(docs.filter("text is null"))
