"""Incremental runs: each processes what arrived since the last one and stops.

The checkpoint is the bookmark. Micro-batches are written under the stream's id
and batch number, so a batch that is retried after a failure is written once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.history import History
from tidemark.plans.history_table import merge_history, write_late
from tidemark.sources.keyed import write_keyed
from tidemark.sources.paths import read_text


def new_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    archive: str | None = None,
    delete: bool = False,
    max_files: int | None = None,
    archive_threads: int = 8,
    **options,
) -> DataFrame:
    """Stream of the files that appear at `path` (a folder or a glob).

    `archive` moves a micro-batch's files there once a later batch has
    committed; files of the last batch stay until then, so the checkpoint, not
    the archive, says what has been processed. The driver moves them one by one
    in `archive_threads` threads; on an object store each move is a copy. `delete`
    deletes them instead, at the same time. plans.landing moves files at once.
    """
    if archive is not None and delete:
        raise ValueError("files can be archived or deleted, not both")
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if archive is not None:
        spark.conf.set("spark.sql.streaming.fileSource.cleaner.numThreads", str(archive_threads))
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if delete:
        reader = reader.option("cleanSource", "delete")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]


def run_available(
    stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, tuple[str, int]], object]
) -> None:
    """Give every waiting micro-batch to `write` with its (stream, number), then stop."""

    def each(batch: DataFrame, number: int) -> None:
        write(batch, (_stream_id(batch.sparkSession, checkpoint), number))

    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_stream(
    stream: DataFrame,
    path: str,
    keys: str | Iterable[str],
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> None:
    """Append new rows to a keyed table, each once."""
    run_available(
        stream, checkpoint, lambda batch, id_: write_keyed(prepare(batch), path, keys, batch_id=id_)
    )


def upsert_stream(
    stream: DataFrame,
    path: str,
    keys: str | Iterable[str],
    order_by: str | Iterable[str | Column],
    checkpoint: str,
    partition_by: str | Iterable[str] = (),
    buckets: int = 0,
) -> None:
    """Keep the newest row per key; `order_by` decides, so files may arrive in any order.

    With `buckets`, a micro-batch reads and rewrites only the buckets of its keys.
    """
    run_available(
        stream,
        checkpoint,
        lambda batch, id_: write_keyed(
            batch, path, keys, order_by, partition_by, dedup=True, batch_id=id_, buckets=buckets
        ),
    )


def history_stream(
    stream: DataFrame,
    path: str,
    spec: History,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    buckets: int = 0,
    late: str = "drop",
    late_path: str | None = None,
) -> None:
    """Merge changes into a history table, micro-batch by micro-batch.

    Files arrive in any order. Changes that arrive after a newer one of their key
    go to a keyed table of their own at `late_path` (by default the history's path
    with "-late"), so that none is lost; late="apply" merges them as they come.
    With `buckets`, a micro-batch looks at the buckets of its keys only.
    """
    spec = replace(spec, late=late)

    def merge(batch: DataFrame, id_: tuple[str, int]) -> None:
        changes = prepare(batch)
        if late == "drop":
            write_late(changes, path, late_path or f"{path}-late", spec, id_)
        merge_history(changes, path, spec, id_, buckets)

    run_available(stream, checkpoint, merge)
