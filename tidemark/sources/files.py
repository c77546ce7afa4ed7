"""File formats: scans, sinks and the list of files below a path."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import col, resolve

# csv has no timestamp type; this format keeps all six fractional digits.
EXACT_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def read_files(
    spark: SparkSession, fmt: str, path: str | list[str], schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """Scan any format Spark has a source for; options reach the source untouched."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_csv(spark: SparkSession, path, schema=None, **options) -> DataFrame:
    return read_files(spark, "csv", path, schema, **options)


def read_parquet(spark: SparkSession, path, schema=None, **options) -> DataFrame:
    return read_files(spark, "parquet", path, schema, **options)


def read_json(spark: SparkSession, path, schema=None, **options) -> DataFrame:
    return read_files(spark, "json", path, schema, **options)


def read_orc(spark: SparkSession, path, schema=None, **options) -> DataFrame:
    return read_files(spark, "orc", path, schema, **options)


def by_folder(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Shuffle rows towards the folder they go to, so that each folder gets few files.

    Adaptive execution cuts large folders into several tasks.
    """
    return df.hint("rebalance", *[col(n) for n in partition_by]) if partition_by else df


def write_files(
    df: DataFrame,
    fmt: str,
    path: str,
    mode: str = "errorifexists",
    partition_by: str | Iterable[str] = (),
    rebalance: bool = True,
    **options,
) -> None:
    """Write any format. With `partition_by`, one folder per value, by default after `by_folder`.

    mode="overwrite" replaces all that is there. mode="overwrite_partitions" replaces
    the partitions that the frame has rows of, all at the end of the write, and
    leaves the others: one day can be run again, also by a frame that reads the
    folder. Otherwise a frame must not overwrite what it reads, which Spark empties first.
    """
    names = resolve(df, partition_by)
    if mode == "overwrite_partitions" and not names:
        raise ValueError("overwrite_partitions needs partition_by")
    kept = "dynamic" if mode == "overwrite_partitions" else "static"
    mode = "overwrite" if mode == "overwrite_partitions" else mode
    options = {"partitionOverwriteMode": kept, **options}
    if rebalance:
        df = by_folder(df, names)
    writer = df.write.format(fmt).mode(mode).options(**options)
    if names:
        writer = writer.partitionBy(*names)
    writer.save(path)


def write_counted(df: DataFrame, fmt: str, path: str, **options) -> int:
    """Write as write_files does; returns how many rows were written, counted by the write itself."""
    df, count = observed(df)
    write_files(df, fmt, path, **options)
    return count()


def observed(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """The frame, and what tells its number of rows once something made from it has been written.

    The rows are counted as they pass, so a run that asks whether there was anything reads it once.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), lambda: seen.get["n"]


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", **options) -> None:
    write_files(df, "csv", path, mode, **options)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", **options) -> None:
    write_files(df, "parquet", path, mode, **options)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists", **options) -> None:
    write_files(df, "json", path, mode, **options)


def write_orc(df: DataFrame, path: str, mode: str = "errorifexists", **options) -> None:
    write_files(df, "orc", path, mode, **options)


def file_manifest(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path, length and time of every file below `path`; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "length", "modificationTime")
    )
