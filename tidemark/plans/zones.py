"""Landing to processed to structured: one source table through its zones."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import as_list, col, resolve
from tidemark.functions.times import HONG_KONG, timestamp_literal
from tidemark.operators.columns import add_column, drop_columns, fill_null_keys, landing_columns, version_columns
from tidemark.operators.filters import in_window, not_deleted
from tidemark.operators.history import History, checked_key, delta, new_versions
from tidemark.operators.latest import keep_last
from tidemark.plans.history_table import read_active, write_versions
from tidemark.session import shared_dir
from tidemark.sources.files import observed, read_parquet, write_parquet
from tidemark.sources.keyed import SEQ, read_keyed, table_exists, write_keyed
from tidemark.sources.paths import file_system


@dataclass(frozen=True)
class Run:
    """One run of one table.

    ts_col     change time of the feed, a UTC wall clock; shifted to `zone` on landing
    op_col     operation code of the feed; None treats every change as a version
    collapse   a batch adds at most one version per key (its newest change);
               False keeps every change as a version
    tie_breaker  feed columns that order changes with equal times, after the commit order;
               versions that start at one instant are told apart by them
    late       what happens to changes not newer than the active version: "apply" or "drop"
    landed_with, versions_with  columns of the caller's on landed rows and on versions, by name
               (see columns.landing_columns)
    key_defaults  what NULL keys become, by column ({} for the defaults by type); None:
               a NULL key stops the run
    """

    keys: list[str] | str
    ts_col: str
    window_from: str | datetime
    window_to: str | datetime
    business_date: str
    op_col: str | None = None
    deleted: str = "D"
    tie_breaker: list[str] | str = ()
    collapse: bool = True
    late: str = "apply"
    key_defaults: Mapping | None = None
    landed_with: Mapping = field(default_factory=dict)
    versions_with: Mapping = field(default_factory=dict)
    zone: str = HONG_KONG

    def __post_init__(self):
        if self.late not in ("apply", "drop"):
            raise ValueError(f"late must be apply or drop, not {self.late}")

    def history(self) -> History:
        """Rules of the structured table; one change per key and batch has no hot keys to look for."""
        return History(
            keys=self.keys,
            ts="effective_from",
            op=self.op_col,
            deleted=self.deleted,
            tie_breaker=as_list(self.tie_breaker),
            late=self.late,
            hot_keys=not self.collapse,
        )


def stage_batch(spark: SparkSession, landing: str, staging: str, schema: T.StructType | str | None = None) -> None:
    """Copy landed files to staging, replacing the batch there; rows learn their file."""
    if landing.rstrip("/") == staging.rstrip("/"):
        raise ValueError("staging would be emptied before it is read")
    df = read_parquet(spark, landing, schema)
    write_parquet(df.select("*", F.col("_metadata.file_name").alias("source_file")), staging, mode="overwrite")


# Day of the change: the processed table's folders, so that a run reads its days only.
DAY = "change_date"


def land(df: DataFrame, processed: str, run: Run, batch_id: tuple[str, int] | None = None) -> int | None:
    """Append a landed batch to the processed table, with its landing columns."""
    if DAY in [c.lower() for c in df.columns]:
        raise ValueError(f"{DAY} is a reserved column name")
    df = landing_columns(df, run.ts_col, run.landed_with, run.zone)
    df = add_column(df, DAY, col(*resolve(df, run.ts_col)).cast("date"))
    return write_keyed(df, processed, [run.ts_col], partition_by=[DAY], dedup=False, batch_id=batch_id)


def _as_datetime(moment: str | datetime) -> datetime:
    return moment if isinstance(moment, datetime) else datetime.fromisoformat(moment)


def changes_in_window(spark: SparkSession, processed: str, run: Run) -> DataFrame:
    """Landed changes from the run's start to its end, both included; other days are not read."""
    first, last = (_as_datetime(t).date() for t in (run.window_from, run.window_to))
    df = read_keyed(spark, processed, with_seq=True).filter(col(DAY).between(first, last))
    return drop_columns(in_window(df, run.ts_col, run.window_from, run.window_to), DAY)


def prepare_changes(changes: DataFrame, run: Run) -> DataFrame:
    """Newest change per key (or all of them) with version columns and filled keys."""
    if run.key_defaults is None:
        changes = changes.withColumns({k: checked_key(k) for k in resolve(changes, run.keys)})
    else:
        changes = fill_null_keys(changes, run.keys, run.key_defaults, unused=True)
    if run.collapse:
        order = [run.ts_col, SEQ, *as_list(run.tie_breaker)]
        changes = keep_last(changes, run.keys, order)
    return version_columns(changes, run.ts_col, run.versions_with)


def _in_commit_order(run: Run) -> History:
    spec = run.history()
    return replace(spec, tie_breaker=[SEQ, *spec.tie_breaker])


def first_versions(changes: DataFrame, run: Run) -> DataFrame:
    """Versions of the initial load: deletes dropped, feed columns removed."""
    feed = [run.ts_col, SEQ, *([run.op_col] if run.op_col else [])]
    if run.collapse:
        if run.op_col:
            changes = not_deleted(changes, run.op_col, run.deleted)
        versions = drop_columns(changes, feed)
    else:
        plain = drop_columns(changes, feed).schema
        versions = new_versions(changes, _in_commit_order(run), plain)
    return add_column(versions, "business_date", timestamp_literal(run.business_date).cast("date"))


def next_versions(current: DataFrame, changes: DataFrame, run: Run) -> DataFrame:
    """What an incremental run changes; its business date goes on every such version."""
    plain = drop_columns(current, "business_date")
    changed = delta(plain, changes, run.history() if run.collapse else _in_commit_order(run))
    return add_column(changed, "business_date", timestamp_literal(run.business_date).cast("date"))


def structure(spark: SparkSession, processed: str, structured: str, run: Run) -> str:
    """Bring the structured table up to date with the run's window.

    Returns what was done: "nothing", "initial" or "incremental".
    """
    if not table_exists(spark, processed):
        return "nothing"
    window = changes_in_window(spark, processed, run)
    if not run.collapse and run.key_defaults is None:  # changes are landed rows with other columns: as cheap to read there as from a copy
        return "nothing" if window.isEmpty() else _merge_changes(spark, structured, prepare_changes(window, run), run)
    # The window is read once: its rows are counted while the changes are written.
    window, count = observed(window)
    changes = prepare_changes(window, run)
    folder = shared_dir(spark, "changes")
    try:
        changes.write.parquet(folder)
        if not count():
            return "nothing"
        return _merge_changes(spark, structured, spark.read.schema(changes.schema).parquet(folder), run)
    finally:
        fs, written = file_system(spark, folder)
        fs.delete(written.getParent(), True)


def _merge_changes(spark: SparkSession, structured: str, changes: DataFrame, run: Run) -> str:
    spec = run.history()
    if not table_exists(spark, structured):
        write_versions(first_versions(changes, run), structured, spec)
        return "initial"
    versions = next_versions(read_active(spark, structured, spec), changes, run)
    write_versions(versions, structured, spec, timestamp_literal(run.window_from))
    return "incremental"
