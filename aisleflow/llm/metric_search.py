"""Exact top-k by inner product with M-trees.

Components become floor(1024 x). One more coordinate brings every vector to the
length M of the longest (queries get 0), so the distance of a query and a vector
falls as their inner product grows: d^2 = |q|^2 + M^2 - 2 q.v. That is the metric
of the trees.

Rows are dealt to the nearest of a bounded number of pivots, the rows of a pivot
to as many trees as their number asks for, so equal vectors in any number fill
trees of one size. A tree has pages of nodes with a centre, a covering radius and
the distance to the parent's centre; leaf pages hold vectors and their distance
to the centre. Query blocks meet tree groups in the cells of a grid. In a cell
the queries of a block go down the trees together: a node is met by those whose lower
bound on the distance (by its radius, and by |d(q, parent) - d(child, parent)| minus the
radius) does not exceed the k-th best, and leaf pages come nearest first. One product of
matrices then gives the scores of a page for all queries that reach it. Queries whose scores
may pass 2 ** 52 go through the pages of all trees one by one, best-first. Each query
starts with the k-th best of a bounded sample of rows as its bound; it is reached
by real rows, so nothing within the answer is ever cut. A window then merges the
cells' answers.

Scores are exact whatever the size of the components: they are taken in doubles
while no product passes 2 ** 52, in 64-bit integers up to 2 ** 62, in Python's
integers beyond. Bounds carry a slack for the rounding of distances, so large
vectors only lose pruning.

Defined cases: a component beyond a 64-bit integer counts as the largest or smallest
one; a score beyond one is given as such, and ranked by its exact value; rows with a null id, a null vector, an empty one or one with a
null or non-finite component take no part; vectors of another length than the
query's are no candidates for it; rows with the same id are rows of their own;
equal scores go to the smaller id. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from aisleflow.llm.common import materialised

SCALE = 1024
TOP = 10
PIVOTS = 64
SAMPLE = 1000
TREE_ROWS = 4096
PAGE = 64
GROUP_TREES = 8
QUERY_BLOCK = 512


def lengthened(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the coordinate that brings them to length ``longest`` (given squared)."""
    rest = np.sqrt(np.maximum(longest - (vectors * vectors).sum(1), 0.0))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0.0))


class Tree:
    """An M-tree in arrays: children of a node, and vectors of a leaf, lie next to each other."""

    def __init__(self, vectors: np.ndarray, longest: float):
        points = lengthened(vectors, longest)
        random = np.random.default_rng(len(vectors))
        nodes = [(np.arange(len(points)), 0, 0.0)]  # members, centre, distance to the parent's centre
        self.centre, self.radius, self.parent, self.first, self.last, self.leaf = [], [], [], [], [], []
        placed, to_centre, at, n_placed = [], [], 0, 0
        while at < len(nodes):
            members, centre, parent = nodes[at]
            away = distances(points[members], points[centre : centre + 1])[:, 0]
            self.centre.append(points[centre])
            self.radius.append(away.max())
            self.parent.append(parent)
            self.leaf.append(len(members) <= PAGE)
            if self.leaf[-1]:
                self.first.append(n_placed)
                placed.append(members)
                to_centre.append(away)
                n_placed += len(members)
                self.last.append(n_placed)
            else:
                self.first.append(len(nodes))
                chosen = members[random.choice(len(members), min(PAGE // 4, -(-len(members) // PAGE) + 1), replace=False)]
                nearest = distances(points[members], points[chosen]).argmin(1)
                parts = [members[nearest == k] for k in range(len(chosen))]
                if max(map(len, parts)) == len(members):  # equal vectors: any even division
                    parts = np.array_split(members, len(chosen))
                for k, part in enumerate(parts):
                    if len(part):
                        own = chosen[k] if nearest.any() else part[0]
                        nodes.append((part, own, float(distances(points[own : own + 1], points[centre : centre + 1])[0, 0])))
                self.last.append(len(nodes))
            at += 1
        self.centre, self.radius, self.parent = np.array(self.centre), np.array(self.radius), np.array(self.parent)
        self.order, self.to_centre = np.concatenate(placed), np.concatenate(to_centre)


class Best:
    """The k best (score, smaller id first) so far, and the bound that they set on the distance."""

    def __init__(self, k: int, start: float, reach: float, dim: int = 0):
        self.k, self.reach, self.bound_score = k, reach, start
        self.slack = 1e-3 + 4e-7 * float(np.sqrt((dim + 1) * reach))  # several times the rounding of a distance
        self.score = np.zeros(0, np.int64)
        self.vec, self.row = self.score, self.score
        self._set()

    def _set(self) -> None:
        self.bound = np.sqrt(max(self.reach * (1 + 1e-12) - 2 * self.bound_score, 0.0)) * (1 + 1e-9) + self.slack

    def add(self, score: np.ndarray, vec: np.ndarray, row: np.ndarray) -> None:
        score, vec, row = (np.concatenate(x) for x in ((self.score, score), (self.vec, vec), (self.row, row)))
        if score.dtype == object:
            kept = sorted(range(len(score)), key=lambda i: (-score[i], vec[i], row[i]))[: self.k]
        else:
            kept = np.lexsort([row, vec, -score])[: self.k]
        self.score, self.vec, self.row = score[kept], vec[kept], row[kept]
        if len(kept) == self.k and self.score[-1] > self.bound_score:
            self.bound_score = float(self.score[-1])
            self._set()


IN_DOUBLES, IN_LONGS = 2.0**52, 2.0**62


def inner_products(vectors: np.ndarray, query: np.ndarray, size: float) -> np.ndarray:
    """Exact inner products, of absolute value up to ``size``, of whole vectors with a whole query."""
    if size < IN_DOUBLES:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    if size < IN_LONGS:
        return vectors.astype(np.int64) @ query.astype(np.int64)
    own = query.tolist()
    return np.array([*(sum(map(mul, v, own)) for v in vectors.tolist()), None], object)[:-1]


def _sortable(scores: np.ndarray) -> tuple[list, list, list, list]:
    """Scores as 64-bit integers, and in three parts whose order is that of the exact scores."""
    exact, low = [int(s) for s in scores], (1 << 62) - 1
    given = [min(max(s, -(1 << 63)), (1 << 63) - 1) for s in exact]
    return given, [s >> 124 for s in exact], [s >> 62 & low for s in exact], [s & low for s in exact]


def search(query: np.ndarray, own_row: int, trees: list[tuple], best: Best) -> int:
    """Best-first through trees given as (tree, vectors, ids, rows), vectors in tree order; number of distances computed."""
    point = np.append(query.astype(np.float64), 0.0)
    size = best.reach  # |q|^2 + M^2 is at least twice any inner product
    computed = 0

    def away(centres: np.ndarray) -> np.ndarray:
        diff = centres - point
        return np.sqrt((diff * diff).sum(1))

    heap: list[tuple] = []
    for t, (tree, *_) in enumerate(trees):
        d = float(away(tree.centre[:1])[0])
        computed += 1
        heapq.heappush(heap, (max(d - tree.radius[0], 0.0), t, 0, d))
    while heap:
        low, t, n, d = heapq.heappop(heap)
        if low > best.bound:
            break
        tree, vectors, ids, rows = trees[t]
        a, b = tree.first[n], tree.last[n]
        if tree.leaf[n]:
            near = a + np.flatnonzero(np.abs(tree.to_centre[a:b] - d) <= best.bound)
            near = near[rows[near] != own_row]
            if len(near):
                computed += len(near)
                best.add(inner_products(vectors[near], query, size), ids[near], rows[near])
            continue
        skip = np.abs(tree.parent[a:b] - d) - tree.radius[a:b]
        near = a + np.flatnonzero(skip <= best.bound)
        found = away(tree.centre[near])
        computed += len(near)
        lows = np.maximum(np.maximum(found - tree.radius[near], skip[near - a]), 0.0)
        for low, child, own in zip(lows.tolist(), near.tolist(), found.tolist()):
            if low <= best.bound:
                heapq.heappush(heap, (low, t, child, own))
    return computed


class Bests:
    """``Best`` of many queries, whose scores are whole numbers that doubles hold."""

    def __init__(self, k: int, starts: np.ndarray, reaches: np.ndarray, dim: int):
        self.k, self.reach, self.bound_score = k, reaches, starts.copy()
        self.slack = 1e-3 + 4e-7 * np.sqrt((dim + 1) * reaches)
        self.score = np.full((len(starts), k), -np.inf)
        self.vec = np.full(self.score.shape, np.iinfo(np.int64).max)
        self.row = self.vec.copy()
        self.bound = np.empty(len(starts))
        self._set(np.arange(len(starts)))

    def _set(self, at: np.ndarray) -> None:
        rest = np.maximum(self.reach[at] * (1 + 1e-12) - 2 * self.bound_score[at], 0.0)
        self.bound[at] = np.sqrt(rest) * (1 + 1e-9) + self.slack[at]

    def add(self, at: np.ndarray, score: np.ndarray, vec: np.ndarray, row: np.ndarray) -> None:
        """Scores of the queries ``at`` (lines) with the vectors of a page (columns); -inf for none."""
        hit = np.flatnonzero((score >= np.maximum(self.bound_score[at], self.score[at, -1])[:, None]).any(1))
        at, score = at[hit], score[hit]
        beside = lambda own, new: np.concatenate([own[at], np.broadcast_to(new, score.shape)], axis=1)
        found = beside(self.score, score), beside(self.vec, vec), beside(self.row, row)
        kept = np.lexsort([found[2], found[1], -found[0]], axis=-1)[:, : self.k]
        self.score[at], self.vec[at], self.row[at] = (np.take_along_axis(x, kept, axis=1) for x in found)
        nearer = at[self.score[at, -1] > self.bound_score[at]]
        self.bound_score[nearer] = self.score[nearer, -1]
        self._set(nearer)


def _pages(points: np.ndarray, trees: list[tuple], bests: Bests) -> list[tuple]:
    """Leaf pages as (lower bounds, tree, node, queries that may have an answer there)."""
    pages = []
    for t, (tree, *_) in enumerate(trees):
        away = distances(points, tree.centre[:1])[:, 0]
        nodes = [(np.maximum(away - tree.radius[0], 0.0), 0, np.arange(len(points)), away)]
        for lows, n, at, away in nodes:
            reached = lows <= bests.bound[at]
            lows, at, away = lows[reached], at[reached], away[reached]
            if not len(at):
                continue
            if tree.leaf[n]:
                pages.append((lows, t, n, at))
                continue
            a, b = tree.first[n], tree.last[n]
            skip = np.abs(tree.parent[a:b] - away[:, None]) - tree.radius[a:b]
            found = distances(points[at], tree.centre[a:b])
            lows = np.maximum(np.maximum(found - tree.radius[a:b], skip), 0.0)
            nodes += [(lows[:, c], a + c, at, found[:, c]) for c in range(b - a)]
    return sorted(pages, key=lambda page: (page[0].min(), *page[1:3]))


def search_all(queries: np.ndarray, own_rows: np.ndarray, trees: list[tuple], bests: Bests) -> int:
    """``search`` for many queries at once; number of inner products computed."""
    points = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
    computed = 0
    for lows, t, n, at in _pages(points, trees, bests):
        at = at[lows <= bests.bound[at]]
        if not len(at):
            continue
        tree, vectors, ids, rows = trees[t]
        own = slice(tree.first[n], tree.last[n])
        scores = queries[at] @ vectors[own].astype(np.float64).T
        scores[own_rows[at][:, None] == rows[own]] = -np.inf
        computed += scores.size
        bests.add(at, scores, ids[own], rows[own])
    return computed


def _matrix(column) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def _grown(longest: dict):
    def run(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        vectors = _matrix(table.column("v"))
        tree = Tree(vectors, longest[dim])
        return pa.table(
            {
                "tree": table.column("tree").slice(0, 1),
                "dim": table.column("dim").slice(0, 1),
                "shape": pa.array([{"first": tree.first, "last": tree.last, "leaf": tree.leaf}]),
                "centre": pa.array([tree.centre.tobytes()]),
                "radius": pa.array([tree.radius.tobytes()]),
                "parent": pa.array([tree.parent.tobytes()]),
                "to_centre": pa.array([tree.to_centre.tobytes()]),
                "vectors": pa.array([np.array(table.column("v").to_pylist(), np.int64)[tree.order].tobytes()]),
                "ids": pa.array([table.column("vec_id").to_numpy()[tree.order].tobytes()]),
                "rows": pa.array([table.column("row").to_numpy()[tree.order].tobytes()]),
            }
        )

    return run


TREE_SCHEMA = (
    "tree long, dim int, shape struct<first:array<long>,last:array<long>,leaf:array<boolean>>, centre binary, "
    "radius binary, parent binary, to_centre binary, vectors binary, ids binary, rows binary"
)


def _read_tree(row: dict) -> tuple:
    tree = Tree.__new__(Tree)
    for name in ("radius", "parent", "to_centre"):
        setattr(tree, name, np.frombuffer(row[name]))
    tree.centre = np.frombuffer(row["centre"]).reshape(len(tree.radius), -1)
    tree.first, tree.last, tree.leaf = row["shape"]["first"], row["shape"]["last"], row["shape"]["leaf"]
    vectors = np.frombuffer(row["vectors"], np.int64).reshape(-1, row["dim"])
    return tree, vectors, np.frombuffer(row["ids"], np.int64), np.frombuffer(row["rows"], np.int64)


FOUND = ("query_id", "query_row", "vec_id", "score", "high", "middle", "low")


def _answered(k: int, longest: dict):
    def run(trees: pa.Table, queries: pa.Table) -> pa.Table:
        read = [_read_tree(row) for row in trees.to_pylist()]
        out: list[list] = [[] for _ in FOUND]

        def give(q: dict, score: np.ndarray, vec: np.ndarray) -> None:
            same = [[q[c]] * len(score) for c in ("vec_id", "row")]
            for column, values in zip(out, [*same, vec.tolist(), *_sortable(score)]):
                column += values

        asked = queries.to_pylist() if read else []
        vectors = [np.array(q["v"], np.int64) for q in asked]
        reach = np.array([float((v.astype(np.float64) ** 2).sum()) + longest[q["dim"]] for q, v in zip(asked, vectors)])
        together = np.flatnonzero(reach < IN_DOUBLES)
        if len(together):
            of = lambda name, kind: np.array([asked[n][name] for n in together], kind)
            bests = Bests(k, of("start", np.float64), reach[together], asked[0]["dim"])  # a cell has vectors of one length
            search_all(np.array([vectors[n] for n in together], np.float64), of("row", np.int64), read, bests)
            for n, score, vec in zip(together, bests.score, bests.vec):
                there = score > -np.inf
                give(asked[n], score[there].astype(np.int64), vec[there])
        for n in np.flatnonzero(reach >= IN_DOUBLES):
            best = Best(k, asked[n]["start"], float(reach[n]), asked[n]["dim"])
            search(vectors[n], asked[n]["row"], read, best)
            give(asked[n], best.score, best.vec)
        return pa.table({n: pa.array(v, pa.int64()) for n, v in zip(FOUND, out)})

    return run


def _placed(pivots: dict, sample: dict, trees: dict, k: int):
    """Tree of each row, and for queries the k-th best of the sample as a first bound."""

    def run(batches):
        for batch in batches:
            tree, start = [], []
            dims, rows, asked = (batch.column(n).to_pylist() for n in ("dim", "row", "query"))
            vectors = batch.column("v").to_pylist()
            for dim, row, is_query, v in zip(dims, rows, asked, vectors):
                v = np.array(v, np.float64)
                p = int(((pivots[dim] - v) ** 2).sum(1).argmin())
                first, count = trees[dim, p] if trees else (0, 1)
                tree.append(first + hash((row, 1)) % count if trees else p)
                bound = -float("inf")
                if is_query and trees:
                    own, of = sample[dim]
                    scores = of[own != row] @ v
                    if len(scores) >= k:
                        rounding = 1e-9 * float(v @ v + (of * of).sum(1).max())
                        bound = float(np.partition(scores, -k)[-k]) - (rounding if rounding >= 1 else 0.0)
                start.append(bound)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tree, pa.int64()), pa.array(start)], names=[*batch.schema.names, "tree", "start"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows for each row that ``is_query`` holds for."""
    spark = vectors.sparkSession
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    table = materialised(
        vectors.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & fine)
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            scaled.alias("v"),
            F.size("embedding").alias("dim"),
            F.coalesce(is_query, F.lit(False)).alias("query"),
        )
        .withColumn("row", F.monotonically_increasing_id()),
        "vectors",
    )
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    longest = {r.dim: float(r.m) for r in table.groupBy("dim").agg(F.max(length).alias("m")).collect()}
    by_hash = Window.partitionBy("dim").orderBy(F.xxhash64("row"), "row")
    bounded = table.withColumn("n", F.row_number().over(by_hash)).filter(F.col("n") <= SAMPLE).select("dim", "row", "v").collect()
    sample = {}
    for dim in longest:
        own = [r for r in bounded if r.dim == dim]
        sample[dim] = (np.array([r.row for r in own]), np.array([r.v for r in own], np.float64))
    pivots = {dim: of[:PIVOTS] for dim, (_, of) in sample.items()}
    schema = "vec_id long, v array<long>, dim int, query boolean, row long, tree long, start double"
    sizes = table.mapInArrow(_placed(pivots, sample, {}, k), schema).groupBy("dim", "tree").count().collect()
    trees, n = {}, 0
    for r in sorted(sizes, key=lambda r: (r.dim, r.tree)):
        trees[r.dim, r.tree] = (n, -(-r["count"] // TREE_ROWS))
        n += trees[r.dim, r.tree][1]
    placed = materialised(table.mapInArrow(_placed(pivots, sample, trees, k), schema), "placed-vectors")
    forest = placed.select("tree", "dim", "vec_id", "row", "v").groupBy("tree").applyInArrow(_grown(longest), TREE_SCHEMA)
    asked = placed.filter("query").select("vec_id", "v", "dim", "row", "start")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    groups = max(1, -(-n // GROUP_TREES))
    cells = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    by_tree = forest.withColumn("g", (F.col("tree") / GROUP_TREES).cast("int")).withColumn("b", cells(blocks))
    by_query = asked.withColumn("b", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).withColumn("g", cells(groups))
    found = (
        by_tree.groupBy("g", "b", "dim")
        .cogroup(by_query.groupBy("g", "b", "dim"))
        .applyInArrow(_answered(k, longest), ", ".join(f"{c} long" for c in FOUND))
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("high"), F.desc("middle"), F.desc("low"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
