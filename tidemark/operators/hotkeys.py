"""Cut keys that hold a large share of the rows into slices of their order.

A window over one key runs in one task. When a key holds many times an even
share of the rows, its rows are cut at points of their order; the window then
runs per (key, slice), and a small per-slice summary carries values across the
cuts. Slices only move work: results are the same with any cut points, so the
sketch that finds hot keys may be approximate and the points may come from a
sample, as Spark's own range partitioning takes them.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import RESERVED, all_of, col
from tidemark.functions.sizes import shuffle_parts
from tidemark.session import shared_dir

SLICE = RESERVED + "slice"
_HASH = RESERVED + "hash"
_CUTS = RESERVED + "cuts"
_AT = RESERVED + "at"
_STEP = RESERVED + "step"
_FIRST = RESERVED + "first"
_LOW = RESERVED + "low"
_HIGH = RESERVED + "high"

# Spark's limit on the size of the sketch.
SKETCH = 1_000_000

# Sampled points per slice.
POINTS = 8


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*[col(k) for k in keys]).alias(_HASH)


def _at(order: list[str]) -> Column:
    """A row's place in its key; compares like ORDER BY order, NULLs first."""
    return F.struct(*[col(o).alias(f"o{i}") for i, o in enumerate(order)])


def kept(few: DataFrame) -> DataFrame:
    """A small table, written to the shared folder: its files tell Spark whether to broadcast it."""
    path = shared_dir(few.sparkSession, "few")
    few.write.parquet(path)
    return few.sparkSession.read.schema(few.schema).parquet(path)


def find_cuts(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame | None:
    """Cut points per hot key, or None when no key is hot.

    One pass with a bounded sketch finds the keys with more than two even shares
    of all rows; of those there are at most half as many as shuffle tasks. A
    sample of their rows, about POINTS per slice, gives the cut points. A key gets
    about one slice per even share, so all keys together get fewer than twice as
    many as there are tasks. The points are written to the shared folder: the
    same in every place of the plan and in every retry, and not held in the driver.
    """
    spark = df.sparkSession
    parts = max(8, shuffle_parts(spark))
    hot = min(parts // 2 + 1, SKETCH)
    top_k = F.expr(f"approx_top_k({_HASH}, {hot}, {min(10 * parts, SKETCH)})")
    total, top = df.select(_hash(keys)).agg(F.count("*"), top_k).first()
    counts = {item["item"]: item["count"] for item in top or [] if item["count"] > 2 * total / parts}
    if not counts:
        return None
    slices = spark.createDataFrame([(key, ceil(n * parts / total)) for key, n in counts.items()], f"{_HASH} long, n int")
    share = min(1.0, POINTS * sum(ceil(n * parts / total) for n in counts.values()) / sum(counts.values()))
    points = (
        df.select(_hash(keys), _at(order).alias(_AT))
        .where(F.col(_HASH).isin(list(counts)))
        .sample(share, seed=1)
        .groupBy(_HASH)
        .agg(F.sort_array(F.collect_list(_AT)).alias(_AT))
        .join(slices, _HASH)
    )
    n, size = F.col("n"), F.size(_AT)
    places = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    cuts = F.transform(places, lambda i: F.get(F.col(_AT), F.floor(i.cast("long") * size / n).cast("int")))
    step = F.ceil(F.sqrt(n)).cast("int")
    return kept(points.select(_HASH, cuts.alias(_CUTS), step.alias(_STEP)))


def _ranges(cuts: DataFrame, width: Column, *more: Column) -> DataFrame:
    """Stretches of `width` slices: the first one, and the cut points before and after them, NULL at the ends."""
    stretch = F.transform(
        F.sequence(F.lit(0), F.size(_CUTS), width),
        lambda i: F.struct(
            i.alias(SLICE), F.get(_CUTS, i - 1).alias(_LOW), F.get(_CUTS, i + width - 1).alias(_HIGH)
        ),
    )
    return cuts.select(_HASH, _STEP, F.inline(stretch)).select(_HASH, SLICE, _LOW, _HIGH, *more)


def _inside(rows: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the range of their keys that holds their place: none or one, as ranges do not overlap."""
    low, high, at = F.col(f"r.{_LOW}"), F.col(f"r.{_HIGH}"), F.col(f"l.{_AT}")
    same = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    holds = all_of([*same, low.isNull() | (low < at), high.isNull() | (at <= high)])
    found = [F.col(f"r.{c}") for c in ranges.columns if c not in (*keys, _LOW, _HIGH)]
    return rows.alias("l").join(ranges.alias("r"), holds, "left").select("l.*", *found)


def with_slices(df: DataFrame, keys: list[str], order: list[str], cuts: DataFrame) -> DataFrame:
    """Add the slice of each row: 0, 1, … along the order for hot keys, NULL otherwise.

    A row's slice is the number of cut points before it: joins find its stretch of
    slices, then the slice within, each among about the root of their number.
    """
    step = F.col(_STEP)
    wide = _ranges(cuts, step).withColumnRenamed(SLICE, _FIRST)
    narrow = _ranges(cuts, F.lit(1), (F.col(SLICE) - F.col(SLICE) % step).alias(_FIRST))
    marked = _inside(df.withColumns({_HASH: _hash(keys), _AT: _at(order)}), wide, [_HASH])
    return _inside(marked, narrow, [_HASH, _FIRST]).drop(_HASH, _AT, _FIRST)


def spread(sliced: DataFrame, keys: list[str]) -> DataFrame:
    """Shuffle by key and slice, as the windows over them need.

    Stated, because rows that come spread by key alone would suit such a window
    too, and all slices of a key would stay in one task.
    """
    return sliced.repartition(*[col(k) for k in keys], SLICE)
