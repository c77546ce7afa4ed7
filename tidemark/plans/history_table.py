"""A history kept as a keyed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import as_column, col, resolve
from tidemark.operators.history import History, delta, late_rows, new_versions
from tidemark.session import shared_dir
from tidemark.sources.keyed import read_keyed, table_exists, write_keyed
from tidemark.sources.paths import file_system


def open_first(spec: History) -> list[Column]:
    """Of versions with one key and start, the open or longest one."""
    return [col(spec.end).desc_nulls_first()]


def read_active(spark: SparkSession, path: str, spec: History) -> DataFrame:
    """Active versions, all that a batch is merged with; partitions of ended ones are not read."""
    return read_keyed(spark, path).filter(col(spec.status) == spec.active)


def _from(spec: History, moment: Column) -> list[Column]:
    """What versions that a change from `moment` on can meet fulfil, one of the conditions each."""
    return [col(spec.end).isNull(), col(spec.end) >= moment]


def read_met(spark: SparkSession, path: str, spec: History, since) -> DataFrame:
    """Versions that changes from `since` on can meet: active ones, and with late="insert" those ended after it."""
    if spec.late != "insert":
        return read_active(spark, path, spec)
    df = read_keyed(spark, path)
    open_, ended = _from(spec, as_column(since).cast(df.schema[resolve(df, spec.end)[0]].dataType))
    return df.filter(open_ | ended)


def write_versions(
    versions: DataFrame,
    path: str,
    spec: History,
    since=None,
    batch_id: tuple[str, int] | None = None,
    buckets: int = 0,
    slices: int = 1,
) -> int | None:
    """Upsert versions by key, start and tie-breakers; `buckets` of a new table are by its business keys.

    The table is partitioned by status: ended versions are only ever added to,
    unless the batch holds them again, and a batch rewrites the active ones at most. `since` is a time before
    which no new version starts; ended versions from before it cannot meet the
    batch and are not read. Late changes put in place (late="insert") rewrite the
    partition of ended versions; `slices` of a new table limit that to their keys'.
    """
    near = []
    if since is not None:
        started = as_column(since).cast(versions.schema[resolve(versions, spec.start)[0]].dataType)
        is_active = col(spec.status).eqNullSafe(spec.active)
        near = [is_active, ~is_active & (col(spec.start) >= started)]
        if spec.late == "insert":
            near = _from(spec, started)
    return write_keyed(
        versions,
        path,
        spec.record_keys(versions),
        open_first(spec),
        partition_by=[spec.status],
        dedup=True,
        replace=True,
        near=near,
        batch_id=batch_id,
        buckets=buckets,
        slices=slices,
        bucket_by=spec.keys,
    )


def merge_history(
    log: DataFrame,
    path: str,
    spec: History,
    batch_id: tuple[str, int] | None = None,
    buckets: int = 0,
    slices: int = 1,
    stored: bool = False,
) -> int | None:
    """Bring the history at `path` up to date with a batch of changes; `buckets`, `slices` as in write_versions.

    `stored` states that the log only reads stored files, which stay as they are: it
    is read from there several times. Any other log is written once before the merge.
    """
    spark = log.sparkSession
    if not table_exists(spark, path):
        return write_versions(new_versions(log, spec), path, spec, batch_id=batch_id, buckets=buckets, slices=slices)
    if stored:
        return _merge_stored(log, path, spec, batch_id)
    # The batch is read several times: write it once, whatever it took to make it.
    folder = shared_dir(spark, "changes")
    try:
        log.write.parquet(folder)
        return _merge_stored(spark.read.schema(log.schema).parquet(folder), path, spec, batch_id)
    finally:
        fs, written = file_system(spark, folder)
        fs.delete(written.getParent(), True)


def _merge_stored(log: DataFrame, path: str, spec: History, batch_id: tuple[str, int] | None) -> int | None:
    (since,) = log.agg(F.min(col(*resolve(log, spec.ts[0])))).first()
    return write_versions(delta(read_met(log.sparkSession, path, spec, since), log, spec), path, spec, since, batch_id)


def write_late(log: DataFrame, path: str, late_path: str, spec: History, batch_id: tuple[str, int]) -> None:
    """Append the changes that `late="drop"` leaves out of the history at `path` to a table of their own."""
    if table_exists(log.sparkSession, path):
        late = late_rows(read_active(log.sparkSession, path, spec), log, spec)
        write_keyed(late, late_path, spec.keys, batch_id=batch_id)
