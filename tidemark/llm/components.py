"""Connected components of links, as joins and aggregates that keep no neighbourhood in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import unit_hash, written
from tidemark.operators.joins import join_grouped


def _relink(edges: DataFrame, smallest: DataFrame) -> DataFrame:
    """Each (a, b) with the smallest of a's neighbours and itself."""
    joined = join_grouped(edges, smallest.withColumnRenamed("a", "node").select(F.col("node").alias("a"), "m"), ["a"])
    return joined.select(F.col("l.a").alias("a"), "b", "m")


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = _relink(both, _smallest(both)).filter("b > a")
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    smallest = _smallest(down)
    linked = _relink(down, smallest).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(smallest.select("a", F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that a link (a, b) of two long columns names.

    The component is the smallest node that links reach. Alternates large-star and
    small-star steps until nothing changes, about log2(longest path) rounds; every
    round is written to the shared folder. Links may repeat, go either way or lead
    to themselves; null ends are left out. No links: no rows.
    """
    edges = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    edges = written(edges.filter("a <> b").distinct())
    before = _state(edges)
    while before[0]:
        edges = written(_small_star(_large_star(edges).filter("a <> b").distinct()).filter("a <> b").distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def clusters(held: DataFrame) -> DataFrame:
    """(node, cluster) of rows (node, key): nodes that keys connect are in one cluster, named by one of its nodes.

    No node is linked with another one. In each round a key takes the least label
    among its holders, and a label the least among its keys, in an order that
    changes by round; then labels stand for nodes, keys of a single label go, and
    equal rows count once. So rows only ever get fewer, and rounds grow with the
    logarithm of the longest path. Columns are longs without nulls; no rows: no rows.
    """
    rows = held.select(F.col("node").alias("label"), "key").distinct()
    named = written(rows.select(F.col("label").alias("node"), "label").distinct())
    seed = 0
    while True:
        seed += 1
        order = F.struct(unit_hash("label", seed=seed), "label")
        keys = rows.groupBy("key").agg(F.min(order).alias("least"), F.max(order).alias("last"))
        keys = keys.filter("least <> last").select("key", "least")
        rows = written(join_grouped(rows, keys, ["key"]).select("label", F.col("l.key").alias("key"), "least"))
        if rows.isEmpty():
            return named.select("node", F.col("label").alias("cluster"))
        moves = rows.groupBy("label").agg(F.min("least").alias("least"))
        moves = written(moves.select("label", F.col("least.label").alias("next")))
        moved = join_grouped(named, moves, ["label"], "left")
        named = written(moved.select("node", F.coalesce("next", F.col("l.label")).alias("label")))
        rows = join_grouped(rows.select("label", "key"), moves, ["label"])
        rows = rows.select(F.col("next").alias("label"), "key").distinct()
