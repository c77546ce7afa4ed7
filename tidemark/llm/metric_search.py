"""Exact search for the vectors with the highest inner products, by an M-tree.

Method: inner products become distances in one more dimension: with M the largest
norm, x is placed at (x, sqrt(M^2 - |x|^2)) and a query at (q, 0), and the nearest
points have the highest products. Below the root are regions around routing
objects, as many as the vectors ask for; each region is one tree or several, and
a tree's nodes are split further until a page holds their vectors. A node stores
its routing object, covering radius and distance to its parent's routing object; a
page also the distances of its vectors to its own. Search goes best first, by a
queue of nodes: the distance to a node's routing object is computed only if the
bound that the stored parent distance gives is within the k-th best, and a vector's
product only if the stored distance to its routing object leaves it within.

Queries are the stated set. A first pass finds each one's k-th best among a bounded
sample of vectors, which is the limit that all searches start with. Then they go to
the tasks in blocks of bounded size, one after the other, and each block searches
every tree where it lies. Only the best k of a task move.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import written

K = 10
REGIONS = 4096  # routing objects below the root, at most
SEEDS, SEED_BYTES = 4096, 8 << 20  # vectors of the sample that the first pass and the regions take, at most
PAGE = 256  # vectors of a page
FANOUT = 16  # children of a node
DRAWS = 4  # sets of routing objects that a split chooses from
TREE_BYTES = 4 << 20  # of vectors in a tree
BLOCK_BYTES = 16 << 20  # of queries that one pass over the trees looks for
SLICE = 1024  # queries that the first pass multiplies at a time
PLACED = "region int, vec_id long, v array<long>"
NODES = {"centers": float, "parent": float, "radius": float, "child": int, "children": int, "item": int, "items": int}
PAGES = {"ids": int, "to_center": float, "vectors": int}
TREES = "region int, " + ", ".join(f"{name} binary" for name in NODES | PAGES)
WANTED = "query_id long, v array<long>, reach double"
FOUND = "query_id long, vec_id long, score long"
Key = tuple[pa.Scalar, ...]


def scaled(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(1024 x) of each component x; null or non-finite vectors and null ids left out."""
    values = F.col(embedding).cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = rows.select(F.col(vec_id).cast("long").alias("vec_id"), values.alias("e"))
    whole = whole.filter(F.col("vec_id").isNotNull() & F.col("e").isNotNull()).filter(~F.coalesce(bad, F.lit(True)))
    return whole.select("vec_id", F.transform("e", lambda x: F.floor(x * 1024).cast("long")).alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, shorter ones filled with 0."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), flat.dtype)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _placed(v: np.ndarray, most: float) -> np.ndarray:
    """Points of vectors in the space of one more dimension."""
    v = v.astype(float)
    rest = np.sqrt(np.maximum(most - np.einsum("ij,ij->i", v, v), 0.0))
    return np.column_stack([v, rest])


def _distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    square = np.einsum("ij,ij->i", points, points)[:, None] + np.einsum("ij,ij->i", centers, centers)[None, :]
    return np.sqrt(np.maximum(square - 2 * points @ centers.T, 0.0))


def _slack(own: np.ndarray | float, most: float) -> np.ndarray | float:
    """More than the rounding of a distance."""
    return 1e-7 * (own + most) ** 0.5 + 1e-6


def _split(points: np.ndarray, own: np.ndarray, to_center: np.ndarray, draw: np.random.Generator) -> list[tuple[int, np.ndarray]]:
    """(routing object, members) of a node's children: of some drawn sets the one with the smallest radii."""
    n = min(FANOUT, -(-2 * len(own) // PAGE))
    best, best_sum = None, np.inf
    for _ in range(DRAWS):
        routes = draw.choice(own, n, replace=False)
        far = _distances(points[own], points[routes])
        label = far.argmin(axis=1)
        radii = np.zeros(n)
        np.maximum.at(radii, label, far[np.arange(len(own)), label])
        if radii.sum() < best_sum:
            best, best_sum = (routes, label), radii.sum()
    routes, label = best
    parts = [(int(routes[i]), own[label == i]) for i in range(n)]
    parts = [(route, members) for route, members in parts if len(members)]
    if len(parts) > 1:
        return parts
    order = own[np.argsort(to_center, kind="stable")]  # no routing object tells them apart
    return [(int(order[a]), order[a : a + PAGE]) for a in range(0, len(order), PAGE)]


def _tree(region: int, center: np.ndarray, ids: np.ndarray, v: np.ndarray, most: float) -> pa.Table:
    """One row: the tree of a group of vectors, nodes level by level, children next to each other."""
    points, draw = _placed(v, most), np.random.default_rng(region)
    members, centers, parent = [np.arange(len(ids))], [center], [0.0]
    radius, child, children, item, items = [], [], [], [], []
    paged, distances, n_paged = [], [], 0
    for at, own in enumerate(members):  # grows while nodes are split
        to_center = np.sqrt(((points[own] - centers[at]) ** 2).sum(axis=1))
        radius.append(to_center.max())
        parts = _split(points, own, to_center, draw) if len(own) > PAGE else []
        child.append(len(members))
        children.append(len(parts))
        item.append(n_paged)
        items.append(0 if parts else len(own))
        if not parts:
            paged.append(own)
            distances.append(to_center)
            n_paged += len(own)
        for route, part in parts:
            members.append(part)
            centers.append(points[route])
            parent.append(np.sqrt(((points[route] - centers[at]) ** 2).sum()))
    order = np.concatenate(paged)
    values = (centers, parent, radius, child, children, item, items, ids[order], np.concatenate(distances), v[order])
    columns = {"region": pa.array([region], pa.int32())}
    for (name, kind), value in zip((NODES | PAGES).items(), values):
        columns[name] = pa.array([np.asarray(value, kind).tobytes()], pa.binary())
    return pa.table(columns)


class _Query:
    """A query's k best so far, and how far from it a better vector can lie."""

    def __init__(self, query_id: int, point: np.ndarray, typed: np.ndarray, reach: float, k: int, most: float):
        self.query_id, self.point, self.typed, self.reach, self.k = query_id, point, typed, reach, k
        own = float(point @ point)
        self.square, self.slack = own + most, _slack(own, most)
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        best = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[best], ids[best]
        if len(best) == self.k:
            rest = self.square - 2.0 * float(self.scores[-1])
            self.reach = min(self.reach, max(rest, 0.0) ** 0.5 + self.slack)


class _Tree:
    """A tree as its row holds it."""

    def __init__(self, row: dict[str, bytes], width: int, exact: bool):
        for name, kind in (NODES | PAGES).items():
            setattr(self, name, np.frombuffer(row[name], kind))
        self.centers = self.centers.reshape(-1, width + 1)
        self.vectors = self.vectors.reshape(-1, width).astype(float if exact else np.int64, copy=False)
        self.products = 0

    def search(self, query: _Query, distance: float) -> None:
        """Add what is within the query's reach; `distance` is that of the first node's routing object."""
        queue = [(max(distance - float(self.radius[0]), 0.0), 0, distance)]
        while queue:
            bound, node, distance = heapq.heappop(queue)
            if bound > query.reach:
                return
            a, b = self.item[node], self.item[node] + self.items[node]
            if b > a:
                near = np.abs(distance - self.to_center[a:b]) <= query.reach
                near &= self.ids[a:b] != query.query_id
                if near.any():
                    self.products += int(near.sum())
                    query.add((self.vectors[a:b][near] @ query.typed).astype(np.int64), self.ids[a:b][near])
                continue
            below = np.arange(self.child[node], self.child[node] + self.children[node])
            bounds = np.abs(distance - self.parent[below]) - self.radius[below]
            below, bounds = below[bounds <= query.reach], bounds[bounds <= query.reach]
            far = np.sqrt(((self.centers[below] - query.point) ** 2).sum(axis=1))
            bounds = np.maximum(np.maximum(bounds, far - self.radius[below]), 0.0)
            for i in np.flatnonzero(bounds <= query.reach).tolist():
                heapq.heappush(queue, (float(bounds[i]), int(below[i]), float(far[i])))


def build_trees(vectors: DataFrame, width: int, most: float, centers: np.ndarray) -> DataFrame:
    """The trees from (vec_id, v): one of each region, several of bounded size where it has many vectors."""
    group = max(TREE_BYTES // (8 * width), 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                own = batch.slice(a, SLICE)
                region = _distances(_placed(_matrix(own.column("v"), width), most), centers).argmin(axis=1)
                columns = [pa.array(region.astype(np.int32)), own.column("vec_id"), own.column("v")]
                yield pa.RecordBatch.from_arrays(columns, ["region", "vec_id", "v"])

    placed = written(vectors.mapInArrow(place, PLACED), "placed")
    counts = placed.groupBy("region").count()  # REGIONS rows at most
    # By draws, so that equal rows spread too; a retried task reads the same file and draws the same.
    part = F.floor(F.rand(0) * (F.floor(F.col("count") / group) + 1)).alias("part")
    parted = placed.join(F.broadcast(counts), "region").select("region", "vec_id", "v", part)

    def build(key: Key, table: pa.Table) -> pa.Table:
        region = key[0].as_py()
        table = table.sort_by("vec_id")
        return _tree(region, centers[region], table["vec_id"].to_numpy(), _matrix(table["v"], width).astype(np.int64), most)

    return parted.groupBy("region", "part").applyInArrow(build, TREES)


def _wanted(queries: DataFrame, width: int, most: float, ids: np.ndarray, seeds: np.ndarray, k: int) -> DataFrame:
    """Queries with the distance of their k-th best among the sample, beyond which nothing is looked for."""

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                own = batch.slice(a, SLICE)
                q = _matrix(own.column("v"), width).astype(float)
                reach = np.full(len(q), np.inf)
                if len(ids) >= k:
                    products = q @ seeds.T
                    products[own.column("query_id").to_numpy()[:, None] == ids[None, :]] = -np.inf
                    square = np.einsum("ij,ij->i", q, q)
                    rest = square + most - 2 * np.partition(products, -k, axis=1)[:, -k]
                    reach = np.sqrt(np.maximum(rest, 0.0)) + _slack(square, most)
                columns = [own.column("query_id"), own.column("v"), pa.array(reach)]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "v", "reach"])

    single = queries.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    return written(single.mapInArrow(first_pass, WANTED), "wanted")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """The `k` highest inner products of each query with vectors of other ids.

    Both frames are (vec_id, v) as from `scaled`. Columns: query_id, rank (from 1),
    vec_id, score; ties go to the smaller id; fewer than `k` rows where there are
    fewer vectors. Shorter vectors count as filled with zeros. Rows of the query's
    id are no candidates; other rows of one id are candidates each. A query id
    that repeats is searched once, with its smallest vector. No vectors or no
    queries: no rows. Builds and stores the trees, and searches, when called; the
    driver holds one block of queries at a time.
    """
    spark = vectors.sparkSession
    square = F.aggregate("v", F.lit(0).cast("double"), lambda s, x: s + x.cast("double") * x)
    facts = vectors.agg(F.max(F.size("v")), F.max(square), F.count(F.lit(1))).first()
    asked = queries.agg(F.max(F.size("v")), F.max(square), F.count_distinct("vec_id")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if facts[0] is None or asked[0] is None:
        return empty
    width, most = max(facts[0], asked[0], 1), float(facts[1] or 0.0)
    exact = max(most, float(asked[1] or 0.0)) < 2.0**52  # products below 2^53 are exact as doubles
    n_seeds = max(min(SEEDS, SEED_BYTES // (8 * width)), 1)
    sample = vectors.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(n_seeds).collect()
    seeds = np.array([r["v"] + [0] * (width - len(r["v"])) for r in sample], float).reshape(-1, width)
    n_regions = min(max(2 * facts[2] * 8 * width // TREE_BYTES, 1), REGIONS, len(seeds))
    centers = _placed(seeds[:n_regions], most)
    trees = written(build_trees(vectors, width, most, centers), "trees")
    ids = np.array([r["vec_id"] for r in sample], np.int64)
    wanted = _wanted(queries, width, most, ids, seeds, k)
    blocks = -(-asked[2] * 8 * width // BLOCK_BYTES)

    def pass_over(block: int) -> DataFrame:
        rows = wanted.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).orderBy("query_id").collect()
        values = np.array([r["v"] + [0] * (width - len(r["v"])) for r in rows], np.int64).reshape(-1, width)
        shared = spark.sparkContext.broadcast(([r["query_id"] for r in rows], values, [r["reach"] for r in rows]))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query_ids, vs, reaches = shared.value
            points = np.column_stack([vs.astype(float), np.zeros(len(vs))])
            typed = points[:, :width] if exact else vs
            own = [_Query(*each, k, most) for each in zip(query_ids, points, typed, reaches)]
            for batch in batches:
                for row in range(batch.num_rows):
                    tree = _Tree({n: batch.column(n)[row].as_buffer() for n in NODES | PAGES}, width, exact)
                    far = np.sqrt(((points - tree.centers[0]) ** 2).sum(axis=1))
                    for at in np.flatnonzero(far - tree.radius[0] <= [q.reach for q in own]).tolist():
                        tree.search(own[at], float(far[at]))
            hits = [q for q in own if len(q.ids)]
            if hits:
                yield pa.RecordBatch.from_pydict(
                    {
                        "query_id": pa.array(np.repeat([q.query_id for q in hits], [len(q.ids) for q in hits])),
                        "vec_id": pa.array(np.concatenate([q.ids for q in hits])),
                        "score": pa.array(np.concatenate([q.scores for q in hits])),
                    }
                )

        found = written(trees.mapInArrow(search, FOUND), "found")
        shared.destroy()
        return found

    found = reduce(DataFrame.unionByName, [pass_over(block) for block in range(blocks)])
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
