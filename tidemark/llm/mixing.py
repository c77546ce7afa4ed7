"""Mixing of sources to target weights by repeating documents.

Method: sizes are summed per source, each source's repetition rate is its target
over its size, and a document is taken floor(rate) times plus once more with the
probability of the remaining fraction, drawn from a seeded hash of its id and text.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import written

SHARE = 1.5
MOST = 2.0
SEED = "mix"
# Source tables up to this many rows are broadcast; beyond, documents are shuffled by source.
BROADCAST_SOURCES = 10_000
SIZED = ["source", "source_size", "weight"]


def word_count(text: str = "text") -> Column:
    """Number of runs of other characters than ASCII whitespace; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(doc_id: str = "doc_id", text: str = "text", seed: str = SEED) -> Column:
    """A number from 0 up to 1 by the id, the text and the seed alone: 52 bits of an md5.

    Documents without an id, or with one that others have too, draw apart as long
    as their texts differ; a null text draws like an empty one.
    """
    own = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    whole = F.concat(F.lit(f"{seed}:"), own, F.lit(":"), F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    return F.conv(F.substring(F.md5(whole), 1, 13), 16, 10).cast("double") / float(1 << 52)


def ranked_sources(sources: DataFrame) -> DataFrame:
    """The rows of `sources` with their rank from 0 by code point of `source`, null last.

    Sorted by range, ranked within each range and shifted by the rows of the
    ranges before, so no task sees all sources.
    """
    ordered = sources.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(
        F.col("source").asc_nulls_last()
    )
    placed = written(ordered.withColumn("at", F.monotonically_increasing_id()))
    part, row = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(part.alias("part")).count().collect()  # one row per task of the sort
    before, shifts = 0, {}
    for part_id, count in sorted(map(tuple, counts)):
        shifts[part_id] = before
        before += count
    shift = F.element_at(F.create_map(*[F.lit(x) for pair in shifts.items() for x in pair]), part) if shifts else F.lit(0)
    return placed.select(*sources.columns, (row + shift).cast("long").alias("rank"))


def source_sizes(docs: DataFrame, size: str = "size", source: str = "source") -> DataFrame:
    """(source, source_size): summed before any shuffle; null is a source of its own."""
    return docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).cast("long").alias("source_size"))


def cyclic_weights(sizes: DataFrame, weights: Sequence[float]) -> DataFrame:
    """(source, source_size, weight): the weights, again and again, by rank of the source."""
    turn = F.pmod(F.col("rank"), F.lit(len(weights))).cast("int") + 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn)
    return ranked_sources(sizes).select("source", "source_size", weight.alias("weight"))


def with_targets(sizes: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size, weight).

    Targets share `share` times all sizes by weight. None is above `most` times its
    source's size; the excess is shared again by weight among the others until none
    is above. What is left when all are at their limit is not given out. A weight
    of null or 0 gets target 0.
    """
    sizes = written(sizes.select(*SIZED).withColumn("weight", F.coalesce("weight", F.lit(0.0))))
    goal = share * float(sizes.agg(F.sum("source_size")).first()[0] or 0)
    limit = most * F.col("source_size")
    level = 0.0
    while True:
        capped = F.lit(level) * F.col("weight") > limit
        given, open_ = sizes.agg(F.sum(F.when(capped, limit)), F.sum(F.when(~capped, F.col("weight")))).first()
        if not open_:
            level = math.inf if given else 0.0
            break
        risen = (goal - (given or 0.0)) / open_
        if risen <= level:
            break
        level = risen
    share_of = F.when(F.col("weight") > 0, F.lit(level) * F.col("weight")).otherwise(F.lit(0.0))
    return sizes.withColumn("target", F.least(limit, share_of))


def planned(docs: DataFrame, targets: DataFrame, chance: Column | None = None) -> DataFrame:
    """`docs` (size, source and others) with source_size, target and copies.

    copies is floor(target / source_size), plus one where the document's `chance`
    (by default its `draw`) is below the fraction; 0 in a source without size or
    target. Rows that are equal in id and text draw alike.
    """
    own = f"_source_{uuid.uuid4().hex}"  # no column of the input's
    few = targets.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    side = targets.select(F.col("source").alias(own), "source_size", "target")
    side = F.broadcast(side) if few else side
    docs = docs.drop("source_size", "target", "copies")
    joined = docs.join(side, F.col("source").eqNullSafe(F.col(own)), "left").drop(own)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + ((draw() if chance is None else chance) < rate - F.floor(rate)).cast("long")
    return joined.withColumn("copies", F.coalesce(copies, F.lit(0)).cast("long"))


def mixed_documents(docs: DataFrame, weights: Sequence[float], share: float = SHARE, most: float = MOST) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of `docs`.

    Sizes are words. Null texts have size 0; their documents are taken like others
    of their source. An empty frame gives an empty mix.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole")  # keeps columns named like ours
    sized = docs.select("source", word_count().alias("size"), draw().alias("chance"), whole)
    targets = with_targets(cyclic_weights(source_sizes(sized), weights), share, most)
    taken = planned(sized, targets, F.col("chance")).filter("copies > 0")
    return taken.select("_whole", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_whole.*")
