"""Landed files taken once, by a manifest table, and moved away at once.

A file is known by path, length and time of change. A run takes the files that
the manifest lacks, notes them there as its batch, processes them, notes the
batch as done and moves its files to the archive. A run that dies is gone on
with by the next one: a batch noted and not done is processed again, with the
same files and under the same number, before new files are looked for.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import joins
from tidemark.sources.files import file_manifest
from tidemark.sources.keyed import catalog_name, read_keyed, table_exists, write_keyed
from tidemark.sources.paths import file_system, has_files

KNOWN = ["path", "length", "modificationTime"]
_SCHEMA = "path string, length long, modificationTime timestamp, batch int, step string"


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """Files taken so far, with their batch and its steps ("taken", "done"); none where there is no manifest."""
    if not table_exists(spark, manifest):
        return spark.createDataFrame([], _SCHEMA)
    return read_keyed(spark, manifest)


def _listed(spark: SparkSession, landing: str) -> DataFrame:
    """Files at a place, but for those that readers pass over too."""
    if not has_files(spark, landing):
        return spark.createDataFrame([], _SCHEMA).select(*KNOWN)
    return file_manifest(spark, landing).filter(~F.col("path").rlike("/[_.][^/]*$")).select(*KNOWN)


def _note(files: DataFrame, manifest: str, batch: int, step: str) -> None:
    rows = files.select(*KNOWN, F.lit(batch).alias("batch"), F.lit(step).alias("step"))
    write_keyed(rows, manifest, "path", batch_id=(step, batch))


def _open_batch(known: DataFrame) -> tuple[int | None, int]:
    """The batch that was taken and not done, if there is one, and the number of the next."""
    done = F.max((F.col("step") == "done").cast("int"))
    last = known.groupBy("batch").agg(done.alias("done")).orderBy(F.desc("batch")).first()
    if last is None:
        return None, 0
    return (None, last["batch"] + 1) if last["done"] else (last["batch"], last["batch"] + 1)


def _move(spark: SparkSession, paths: list[str], landing: str, to: str, threads: int) -> None:
    """Move files below `to`, by their place below `landing`; files that are gone were moved before."""
    fs, base = file_system(spark, landing)
    base = fs.makeQualified(base).toString().rstrip("/")

    def move(path: str) -> None:
        _, file = file_system(spark, path)
        file = fs.makeQualified(file)
        if fs.exists(file):
            _, target = file_system(spark, f"{to}/{file.toString().removeprefix(base).lstrip('/')}")
            fs.mkdirs(target.getParent())
            if not fs.rename(file, target):
                raise OSError(f"{path} could not be moved to {target.toString()}")

    with ThreadPoolExecutor(max_workers=threads) as pool:
        list(pool.map(move, paths))


def take_files(
    spark: SparkSession,
    landing: str,
    manifest: str,
    write: Callable[[DataFrame, tuple[str, int]], object],
    schema: T.StructType | str,
    fmt: str = "parquet",
    archive: str | None = None,
    threads: int = 8,
    **options,
) -> list[int]:
    """Give the files at `landing` that `manifest` (a keyed table) lacks to `write`; returns the batches done.

    `write` gets the rows and (manifest, batch), by which it must write a batch
    once, as keyed tables do. With `archive`, a batch's files are moved to a folder
    of its own there when it is done, the last batch's too. One run at a time;
    only the paths of a batch's files come to the driver, as in any read.
    """
    batches = []
    while True:
        known = read_manifest(spark, manifest)
        batch, number = _open_batch(known)
        if batch is None:
            listed = _listed(spark, landing)
            if archive is not None:  # what a run that died has done and not moved
                done = joins.join_on_keys(listed, known.filter("step = 'done'"), KNOWN).select("batch", "path").collect()
                for left in {r["batch"] for r in done}:
                    _move(spark, [r["path"] for r in done if r["batch"] == left], landing, f"{archive}/batch={left}", threads)
                if done:
                    continue
            new = joins.rows_untouched(listed, known, KNOWN).collect()
            if not new:
                return batches
            batch = number
            _note(spark.createDataFrame(new, listed.schema), manifest, batch, "taken")
        files = read_manifest(spark, manifest).filter((F.col("batch") == batch) & (F.col("step") == "taken"))
        rows = files.orderBy("path").collect()
        paths = [r["path"] for r in rows]
        write(spark.read.format(fmt).schema(schema).options(**options).load(paths), (catalog_name(manifest), batch))
        _note(spark.createDataFrame(rows, files.schema), manifest, batch, "done")
        batches.append(batch)
        if archive is not None:
            _move(spark, paths, landing, f"{archive}/batch={batch}", threads)
