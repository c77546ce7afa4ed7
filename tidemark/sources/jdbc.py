"""JDBC tables. The driver jar of the database must be on the class path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, properties: Mapping[str, str] | None = None) -> dict[str, str]:
    return {**(properties or {}), "url": url, "dbtable": table}


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    *,
    split_by: str,
    bounds: tuple,
    splits: int,
) -> DataFrame:
    """Scan a database table; filters and the column list run in the database.

    `splits` tasks read equal ranges of `split_by` between `bounds` (rows outside
    go to the first and last one); no table is read by a single task unasked.
    """
    reader = spark.read.format("jdbc").options(**jdbc_options(url, table, properties))
    split = {"lowerBound": str(bounds[0]), "upperBound": str(bounds[1]), "numPartitions": str(splits)}
    return reader.options(partitionColumn=split_by, **split).load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    mode: str = "errorifexists",
    connections: int = 16,
) -> None:
    """Write to a database table over at most `connections` connections."""
    options = {**jdbc_options(url, table, properties), "numPartitions": str(connections)}
    df.write.format("jdbc").mode(mode).options(**options).save()
