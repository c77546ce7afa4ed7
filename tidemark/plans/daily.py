"""The daily job of one table: new landing files to processed, then to structured."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark.plans.landing import take_files
from tidemark.plans.zones import Run, land, structure
from tidemark.sources.files import read_files
from tidemark.sources.paths import has_files
from tidemark.streaming.ingest import new_files, run_available


@dataclass(frozen=True)
class Zones:
    """Where one table's zones are; without `backup`, landed files stay where they are.

    `bookmark` is the checkpoint of a file stream; with `manifest`, a keyed table,
    files are taken by that instead, and all of them are in `backup` after a run.
    """

    landing: str
    processed: str
    structured: str
    bookmark: str
    backup: str | None = None
    manifest: str | None = None
    fmt: str = "parquet"


def run_table(spark: SparkSession, zones: Zones, run: Run, schema: T.StructType | str | None = None) -> str:
    """Take in files not seen before, then bring the structured table up to date.

    Returns what happened to the structured table: "nothing", "initial" or
    "incremental". Without new files the processed zone is still looked at.
    """
    if has_files(spark, zones.landing):
        if schema is None:
            if zones.fmt not in ("parquet", "orc"):
                raise ValueError(f"give the schema of {zones.fmt} files: to infer it would read all that ever landed")
            schema = read_files(spark, zones.fmt, zones.landing).schema
        if zones.manifest is None:
            landed = new_files(spark, zones.landing, schema, zones.fmt, archive=zones.backup)
            run_available(landed, zones.bookmark, lambda batch, id_: land(batch, zones.processed, run, id_))
    if zones.manifest is not None and schema is not None:
        take_files(
            spark, zones.landing, zones.manifest, lambda rows, id_: land(rows, zones.processed, run, id_),
            schema, zones.fmt, zones.backup,
        )
    return structure(spark, zones.processed, zones.structured, run)
