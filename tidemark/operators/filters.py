"""Row predicates. All stay column expressions, so Catalyst can push them down."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.names import col, resolve
from tidemark.functions.times import timestamp_literal


def in_window(df: DataFrame, ts_col: str, start, end, half_open: bool = False) -> DataFrame:
    """Rows from `start` to `end`, both ends included.

    With both ends included, neighbouring windows share the instant between
    them; `half_open` leaves `end` to the next window.
    """
    (name,) = resolve(df, ts_col)
    start, end = timestamp_literal(start), timestamp_literal(end)
    if half_open:
        return df.filter((col(name) >= start) & (col(name) < end))
    return df.filter(col(name).between(start, end))


def not_deleted(df: DataFrame, op_col: str = "op", deleted: str = "D") -> DataFrame:
    """Rows whose operation is known and no delete."""
    (name,) = resolve(df, op_col)
    return df.filter(col(name) != deleted)


def is_nonempty(df: DataFrame) -> bool:
    """Whether any row exists; stops at the first one instead of counting."""
    return not df.isEmpty()
