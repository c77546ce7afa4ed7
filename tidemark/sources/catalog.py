"""Catalog tables: create, insert, select, drop, and SQL with bound values."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.names import as_list, col, quoted, resolve


def _name(name: str) -> str:
    """A table or database name, its parts quoted."""
    return ".".join(quoted(part.strip("`")) for part in name.split("."))


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    escaped = (location or "").replace("\\", "\\\\").replace("'", "\\'")
    place = f" LOCATION '{escaped}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(name)}{place}")


def create_table(
    spark: SparkSession, name: str, columns: str, fmt: str = "parquet", partition_by: str | Iterable[str] = ()
) -> None:
    """Create a table from column definitions such as "id INT, name STRING"."""
    parts = as_list(partition_by)
    split = f" PARTITIONED BY ({', '.join(quoted(p) for p in parts)})" if parts else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(name)} ({columns}) USING {fmt}{split}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_name(name)}")


def insert_values(spark: SparkSession, name: str, columns: Sequence[str], values: Sequence) -> None:
    """Insert one row; values are bound, so quotes, NULL and dates arrive as they are."""
    marks = ", ".join("?" for _ in values)
    names = ", ".join(quoted(c) for c in columns)
    spark.sql(f"INSERT INTO {_name(name)} ({names}) VALUES ({marks})", args=list(values))


def insert_rows(df: DataFrame, name: str) -> None:
    """Insert a frame's rows, columns matched by name."""
    target = df.sparkSession.table(name).columns
    df.select(*[col(c) for c in resolve(df, target)]).write.insertInto(name)


def select_table(
    spark: SparkSession, name: str, columns: str | Iterable[str] = "*", where: str | None = None
) -> DataFrame:
    """Columns of a table, optionally filtered by a SQL condition."""
    df = spark.table(name)
    if where:
        df = df.where(where)
    return df if columns == "*" else df.select(*[col(c) for c in resolve(df, columns)])


def run_sql(spark: SparkSession, query: str, args: Mapping | Sequence | None = None, **frames: DataFrame) -> DataFrame:
    """Run SQL with bound values; `frames` are named in the text as {name}."""
    return spark.sql(query, args=args, **frames)


def exists(spark: SparkSession, table: str, fmt: str = "parquet") -> bool:
    """Whether there is a table of that name or, if it has a slash, data in that folder.

    Only a missing one is "no": a table that is there and cannot be read raises, so
    that it is not taken for one to be loaded for the first time.
    """
    if "/" not in table:
        return spark.catalog.tableExists(table)
    try:
        spark.read.format(fmt).load(table)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True
