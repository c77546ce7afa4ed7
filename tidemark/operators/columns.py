"""Projections: rename, replace, add, drop, cast, fill keys, audit columns."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping
from numbers import Number

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import as_column, as_list, col, resolve
from tidemark.functions.times import HONG_KONG, shift_timezone


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename all columns at once, so names can be swapped; unknown names are ignored."""
    new = {old.lower(): name for old, name in mapping.items()}
    names = [new.get(c.lower(), c) for c in df.columns]
    twice = [n for n, k in Counter(n.lower() for n in names).items() if k > 1]
    if twice:
        raise ValueError(f"rename gives duplicate columns: {twice}")
    return df.select(*[col(c).alias(n) for c, n in zip(df.columns, names)])


def _kind(value) -> type:
    return bool if isinstance(value, bool) else str if isinstance(value, str) else Number


def _replaced(column: Column, dtype: T.DataType, mapping: Mapping) -> Column | None:
    """`column` with the values of `mapping` replaced; None if none of them can occur."""
    kind = bool if isinstance(dtype, T.BooleanType) else str if isinstance(dtype, T.StringType) else Number
    whole = isinstance(dtype, T.IntegralType)
    out = None
    for old, new in mapping.items():
        # Whole numbers are compared as such: as doubles, large ones would meet their neighbours.
        if _kind(old) is not kind or (whole and not (isinstance(old, int) or float(old).is_integer())):
            continue
        match = column == F.lit(int(old) if whole else old)
        value = F.lit(new).cast(dtype)
        out = F.when(match, value) if out is None else out.when(match, value)
    return None if out is None else out.otherwise(column)


def replace_values(df: DataFrame, mapping: Mapping, subset: str | Iterable[str] | None = None) -> DataFrame:
    """Replace values in all columns of the matching type, all at once.

    A mapping may mix booleans, numbers and strings; each kind touches only its
    own columns. A value may become NULL; NULL itself is no source.
    """
    if None in mapping:
        raise ValueError("NULL cannot be replaced; use fill_null_keys")
    mixed = [old for old, new in mapping.items() if new is not None and _kind(old) is not _kind(new)]
    if mixed:
        raise ValueError(f"values must stay of their kind: {mixed}")
    names = set(resolve(df, subset) if subset is not None else df.columns)
    fields = [
        f for f in df.schema if f.name in names and isinstance(f.dataType, (T.NumericType, T.StringType, T.BooleanType))
    ]
    changed = {f.name: _replaced(col(f.name), f.dataType, mapping) for f in fields}
    return df.withColumns({name: value for name, value in changed.items() if value is not None})


def add_columns(df: DataFrame, values: Mapping) -> DataFrame:
    """Add or overwrite columns in one projection; plain values become literals."""
    return df.withColumns({name: as_column(value) for name, value in values.items()})


def add_column(df: DataFrame, name: str, value) -> DataFrame:
    return add_columns(df, {name: value})


def drop_columns(df: DataFrame, columns: str | Iterable[str]) -> DataFrame:
    """Drop columns without regard to case; unknown names are ignored."""
    gone = {c.lower() for c in as_list(columns)}
    return df.select(*[col(c) for c in df.columns if c.lower() not in gone])


def _lenient(df: DataFrame, name: str, dtype: T.DataType) -> Column:
    value = col(name).try_cast(dtype)
    text = isinstance(df.schema[name].dataType, T.StringType)
    if text and isinstance(dtype, (T.IntegralType, T.DecimalType)):
        # A failing cast raises and catches per row; text without a digit need not try.
        return F.when(col(name).rlike("[0-9]"), value)
    return value


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Cast columns; values that do not fit become NULL, or raise when strict."""
    names = resolve(df, list(types))
    wanted = {n: T.DataType.fromDDL(t) if isinstance(t, str) else t for n, t in zip(names, types.values())}
    return df.withColumns({n: col(n).cast(t) if strict else _lenient(df, n, t) for n, t in wanted.items()})


# What an absent key becomes, by type.
KEY_DEFAULTS = {
    "string": "",
    "boolean": False,
    "date": "1900-01-01",
    "timestamp": "1900-01-01 00:00:00",
    "timestamp_ntz": "1900-01-01 00:00:00",
}


def fill_null_keys(
    df: DataFrame, keys: str | Iterable[str], defaults: Mapping | None = None, unused: bool = False
) -> DataFrame:
    """Give NULL key values a default, so that they compare equal to themselves.

    With `unused`, a row that has the default as a key of its own stops the query:
    it would be taken for the rows without a key.
    """
    given = {k.lower(): v for k, v in (defaults or {}).items()}
    filled = {}
    for name in resolve(df, keys):
        dtype = df.schema[name].dataType
        default = given.get(name.lower(), KEY_DEFAULTS.get(dtype.simpleString()))
        if default is None and isinstance(dtype, T.NumericType):
            default = 0
        if default is None:
            raise ValueError(f"no default for key {name} of type {dtype.simpleString()}")
        value = as_column(default).cast(dtype)
        known = col(name)
        if unused:
            message = f"the default of key {name} is a key in use: give another one"
            known = F.when(col(name) == value, F.raise_error(F.lit(message)).cast(dtype)).otherwise(col(name))
        filled[name] = F.coalesce(known, value)
    return df.withColumns(filled)


def landing_columns(df: DataFrame, ts_col: str, audit: Mapping, zone: str = HONG_KONG) -> DataFrame:
    """A landed batch with its change time in `zone` and the caller's columns.

    `audit` has by name a constant, a Column, or a function without arguments that
    makes one of them when the batch is planned.
    """
    (ts_col,) = resolve(df, ts_col)
    return add_columns(df, {ts_col: shift_timezone(col(ts_col), zone), **made(audit)})


def version_columns(df: DataFrame, ts_col: str, audit: Mapping) -> DataFrame:
    """The newest change of a key as a version that is valid from it on, with the caller's columns as above."""
    (ts_col,) = resolve(df, ts_col)
    valid = {"effective_from": col(ts_col), "effective_to": F.lit(None).cast("timestamp_ntz"), "status": "active"}
    return add_columns(df, {**valid, **made(audit)})


def made(values: Mapping) -> dict:
    """The values, with functions replaced by what they return."""
    return {n: v() if callable(v) and not isinstance(v, Column) else v for n, v in values.items()}
