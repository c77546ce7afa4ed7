"""Equi-joins on key lists, and union by name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import all_of, col, quoted, resolve


def join_on_keys(left: DataFrame, right: DataFrame, keys: str | Iterable[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, each key once in the result; NULL keys match nothing.

    Frames that lie spread by the keys already, such as bucketed tables, are not
    shuffled again. See join_grouped for a hot key against grouped rows.
    """
    names = resolve(left, keys)
    resolve(right, names)
    return left.join(right, on=names, how=how)


def key_condition(keys: list[str], left: str = "l", right: str = "r", null_safe: bool = True) -> Column:
    pairs = [(F.col(f"{left}.{quoted(k)}"), F.col(f"{right}.{quoted(k)}")) for k in keys]
    return all_of([a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; the map-side part also shrinks a key that repeats often."""
    return df.select(*[col(k) for k in resolve(df, keys)]).distinct()


def join_grouped(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """Join "l" with "r", which has one row per key, such that a hot key of "l" can be split.

    Adaptive execution splits a key only where both sides come from the join's
    own shuffle. A side grouped by the same keys would bring the shuffle of its
    grouping along. Null-safe comparison shuffles on other expressions, so the
    join gets its own; without NULL keys on the right it means the same.
    """
    if not null_safe:
        right = right.filter(all_of([col(k).isNotNull() for k in keys]))
    return left.alias("l").join(right.alias("r"), key_condition(keys), how)


def rows_touched(df: DataFrame, by: DataFrame, keys: str | Iterable[str], null_safe: bool = False) -> DataFrame:
    """Rows of `df` whose key occurs in `by`, each once."""
    names = resolve(df, keys)
    return join_grouped(df, distinct_keys(by, names), names, "left_semi", null_safe)


def rows_untouched(df: DataFrame, by: DataFrame, keys: str | Iterable[str], null_safe: bool = False) -> DataFrame:
    """Rows of `df` whose key does not occur in `by`."""
    names = resolve(df, keys)
    return join_grouped(df, distinct_keys(by, names), names, "left_anti", null_safe)


def union_by_name(first: DataFrame, second: DataFrame, allow_missing: bool = False) -> DataFrame:
    """All rows of both frames, columns matched by name."""
    return first.unionByName(second, allowMissingColumns=allow_missing)
