"""Row order within a key: keep last or first, row numbers, next value."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import RESERVED, all_of, as_list, col, quoted, resolve
from tidemark.operators.hotkeys import SLICE, find_cuts, kept, spread, with_slices

_RANK = RESERVED + "rank"
_TIE = RESERVED + "tie"


def ordering(df: DataFrame, order_by, ascending: bool) -> list[Column]:
    """Sort columns from names, or sort expressions taken as they are."""
    if isinstance(order_by, (str, Column)):
        order_by = [order_by]
    out: list[Column] = []
    for item in order_by:
        if isinstance(item, Column):
            out.append(item)
        else:
            out += [col(n).asc() if ascending else col(n).desc() for n in resolve(df, item)]
    return out


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return _has_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_has_map(f.dataType) for f in dtype)
    return not isinstance(dtype, T.AtomicType)


def content_hash(df: DataFrame) -> Column:
    """Hash of a row's content: a repeatable tie-breaker under task retries."""
    return F.xxhash64(*[col(f.name) for f in df.schema if not _has_map(f.dataType)])


def _keep(df: DataFrame, keys, order_by, ascending: bool, unique_order: bool) -> DataFrame:
    names = resolve(df, keys)
    order = ordering(df, order_by, ascending)
    if not unique_order:
        order.append(content_hash(df))
    window = Window.partitionBy(*[col(k) for k in names]).orderBy(*order)
    # Spark turns "rank = 1" into a group limit before the shuffle, so each task
    # sends at most one row per key, also for a key with very many rows.
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def first_of_few(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key where no key has more than a few rows.

    Skips the sort that a group limit does before the shuffle and that could
    drop next to nothing here.
    """
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    marked = df.withColumn(_RANK, F.lag(F.lit(True)).over(window))
    return marked.filter(F.col(_RANK).isNull()).drop(_RANK)


def keep_last(
    df: DataFrame,
    keys: str | Iterable[str],
    order_by: str | Column | Iterable[str | Column],
    ascending: bool = False,
    unique_order: bool = False,
) -> DataFrame:
    """The newest row per key; NULL keys are one key, NULL order values come last.

    Names in `order_by` sort descending; sort expressions are used as given.
    Ties go by row content, so that a retried task picks the same row;
    `unique_order` states that there are none and saves reading the other columns.
    """
    return _keep(df, keys, order_by, ascending, unique_order)


def keep_first(
    df: DataFrame,
    keys: str | Iterable[str],
    order_by: str | Column | Iterable[str | Column],
    unique_order: bool = False,
) -> DataFrame:
    """The oldest row per key; rows without an order value count as oldest."""
    return _keep(df, keys, order_by, True, unique_order)


def _ordered(df: DataFrame, order: list[str], unique: bool) -> tuple[DataFrame, list[str]]:
    """The frame and its order columns, with the row content as the last one unless the order is unique."""
    return (df, order) if unique else (df.withColumn(_TIE, content_hash(df)), [*order, _TIE])


def _slice_keys(df: DataFrame, names: list[str]) -> Column:
    same = [F.col(f"l.{quoted(k)}").eqNullSafe(F.col(f"r.{quoted(k)}")) for k in names]
    return all_of([*same, F.col(f"l.{SLICE}") == F.col(f"r.{SLICE}")])


def row_number_per_key(
    df: DataFrame,
    keys: str | Iterable[str],
    order_by: str | Iterable[str],
    name: str = "row_number",
    ascending: bool = True,
    unique_order: bool = False,
    hot_keys: bool = True,
) -> DataFrame:
    """Number the rows of each key from 1 along the order.

    Ties go by row content unless `unique_order` states that there are none.
    `hot_keys=False` states that no key holds a large share of the rows.
    """
    names, order_names = resolve(df, keys), resolve(df, order_by)
    columns = [c for c in df.columns if c.lower() != name.lower()]
    df, order_names = _ordered(df, order_names, unique_order)
    order = ordering(df, order_names, ascending)
    key_cols = [col(k) for k in names]
    number = F.row_number()
    cuts = find_cuts(df, names, order_names) if hot_keys else None
    if cuts is None:
        numbered = df.withColumn(name, number.over(Window.partitionBy(*key_cols).orderBy(*order)).cast("bigint"))
        return numbered.select(*[col(c) for c in columns], col(name))
    sliced = with_slices(df, names, order_names, cuts)
    along = F.col(SLICE).asc() if ascending else F.col(SLICE).desc()
    before = Window.partitionBy(*key_cols).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    offset = RESERVED + "offset"
    # One row per slice of a hot key.
    offsets = kept(
        sliced.where(F.col(SLICE).isNotNull())
        .groupBy(*key_cols, SLICE)
        .agg(F.count("*").alias(offset))
        .withColumn(offset, F.coalesce(F.sum(offset).over(before), F.lit(0)))
    )
    within = Window.partitionBy(*key_cols, F.col(SLICE)).orderBy(*order)
    return (
        spread(sliced, names)
        .withColumn(name, number.over(within))
        .alias("l")
        .join(offsets.alias("r"), _slice_keys(df, names), "left")
        .select(
            *[F.col(f"l.{quoted(c)}") for c in columns],
            (F.col(f"l.{quoted(name)}") + F.coalesce(F.col(f"r.{offset}"), F.lit(0))).alias(name),
        )
    )


def lead_in_key(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    name: str,
    cuts: DataFrame | None,
    cut_by: list[str],
) -> DataFrame:
    """Add `name`: `value` of the next row of the key in ascending order, NULL at the last.

    The order must not run against `cut_by`, the order the cuts were taken in:
    rows that are smaller by it, or NULL, come first.
    """
    key_cols, order_cols = [col(k) for k in keys], [col(o).asc() for o in order]
    if cuts is None:
        return df.withColumn(name, F.lead(col(value)).over(Window.partitionBy(*key_cols).orderBy(*order_cols)))
    sliced = with_slices(df, keys, cut_by, cuts)
    within = Window.partitionBy(*key_cols, F.col(SLICE)).orderBy(*order_cols)
    along = Window.partitionBy(*key_cols).orderBy(SLICE)
    after, found = RESERVED + "after", RESERVED + "found"
    first = F.min(F.struct(*[col(o).alias(f"o{i}") for i, o in enumerate(order)], col(value).alias("value")))
    # One row per slice of a hot key.
    firsts = kept(
        sliced.where(F.col(SLICE).isNotNull())
        .groupBy(*key_cols, SLICE)
        .agg(first.alias(after))
        .withColumn(after, F.lead(after).over(along))
    )
    return (
        spread(sliced, keys)
        .withColumn(name, F.lead(col(value)).over(within))
        .withColumn(found, F.lead(F.lit(True)).over(within))
        .alias("l")
        .join(firsts.alias("r"), _slice_keys(df, keys), "left")
        .select(
            *[F.col(f"l.{quoted(c)}") for c in df.columns if c.lower() != name.lower()],
            F.when(F.col(f"l.{found}"), F.col(f"l.{quoted(name)}"))
            .otherwise(F.col(f"r.{after}.value"))
            .alias(name),
        )
    )


def lead_next(
    df: DataFrame,
    keys: str | Iterable[str],
    order_by: str | Iterable[str],
    value: str,
    name: str = "next_value",
    unique_order: bool = False,
    hot_keys: bool = True,
) -> DataFrame:
    """Add the value of the next row of the same key, NULL at the last row.

    Ties go by row content unless `unique_order` states that there are none.
    `hot_keys=False` states that no key holds a large share of the rows.
    """
    names, order = resolve(df, keys), resolve(df, as_list(order_by))
    (value,) = resolve(df, value)
    columns = [c for c in df.columns if c.lower() != name.lower()]
    df, order = _ordered(df, order, unique_order)
    cuts = find_cuts(df, names, order) if hot_keys else None
    return lead_in_key(df, names, order, value, name, cuts, order).select(*[col(c) for c in columns], col(name))
