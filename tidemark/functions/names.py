"""Naming rules shared by all operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESERVED = "__tm_"


def as_list(names: str | Iterable[str] | None) -> list[str]:
    """One rule for key arguments: a list, or text with commas between names."""
    if names is None:
        return []
    if isinstance(names, str):
        names = names.split(",")
    return [n.strip() for n in names if n.strip()]


def resolve(df: DataFrame, names: str | Iterable[str]) -> list[str]:
    """The frame's own spelling of `names`, compared without case as Spark does."""
    known = {c.lower(): c for c in df.columns}
    names = as_list(names)
    missing = [n for n in names if n.lower() not in known]
    if missing:
        raise ValueError(f"no such column: {missing}; have {df.columns}")
    return [known[n.lower()] for n in names]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Column by exact name, also when the name holds dots."""
    return F.col(quoted(name))


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(and_, conditions)


def same_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of `schema`, by name and in its order, cast where types differ."""
    names = resolve(df, [f.name for f in schema])
    types = dict(df.dtypes)
    return df.select(
        *[
            (col(n) if types[n] == f.dataType.simpleString() else col(n).cast(f.dataType)).alias(f.name)
            for n, f in zip(names, schema)
        ]
    )
