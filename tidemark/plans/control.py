"""Runs driven by a control table: which tables are due, run them, mark them done."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import all_of, as_column, col, quoted
from tidemark.operators.columns import made
from tidemark.operators.joins import join_grouped
from tidemark.sources.keyed import read_keyed, write_keyed

log = logging.getLogger(__name__)


def with_config(control: DataFrame, config: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Control rows with their configuration, one row per table; rows without one stay.

    `on` maps control columns to the configuration's.
    """
    names = {theirs: ours for ours, theirs in on.items()}
    rest = [F.col("r." + quoted(n)) for n in config.columns if n not in names]
    config = config.select(*[col(n).alias(names.get(n, n)) for n in config.columns])
    return join_grouped(control, config, list(on), "left").select("l.*", *rest)


def pending(control: DataFrame, **equal) -> DataFrame:
    """Control rows whose columns have the given values."""
    return control.filter(all_of([col(name) == as_column(value) for name, value in equal.items()]))


def pending_count(control: DataFrame, **equal) -> DataFrame:
    return pending(control, **equal).agg(F.count("*").alias("n_jobs"))


def update_where(df: DataFrame, match: Column, values: Mapping) -> DataFrame:
    """Rows that match get the new values, functions what they return; all others stay as they are."""
    values = made(values)
    types = {f.name: f.dataType for f in df.schema}
    return df.withColumns(
        {n: F.when(match, as_column(v).cast(types[n])).otherwise(col(n)) for n, v in values.items()}
    )


def run_pending(
    spark: SparkSession,
    control_path: str,
    run_one: Callable[[dict], str],
    keys: Sequence[str],
    due: Mapping,
    done: Mapping,
    table_by: Sequence[str] = (),
    config: DataFrame | None = None,
    on: Mapping[str, str] | None = None,
    parallel: int = 4,
) -> dict[tuple, str]:
    """Run every due row of a keyed control table and mark those that worked.

    Rows with the values of `due` are due, and get the values of `done` then (see
    update_where; what the time is then, a function says).
    Only the control rows come to the driver, one per run. Each run is a set of
    Spark jobs of its own; `parallel` of them submit theirs at a time, so that
    small tables do not leave the cluster idle. Each table's jobs run in a pool of
    its own, so with fair scheduling (session.AT_START) a long table does not hold
    up short ones. Rows that agree in `table_by`
    (default: `keys`) concern one table and run one after another in the order
    of `keys`. A run that fails stays due, as do later ones of its table, and
    its error is raised after the others are marked.
    """
    jobs = pending(read_keyed(spark, control_path), **due)
    if config is not None:
        jobs = with_config(jobs, config, on)
    tables: dict[tuple, list[dict]] = {}
    for row in jobs.orderBy(*keys).collect():
        tables.setdefault(tuple(row[k] for k in table_by or keys), []).append(row.asDict())
    outcome: dict[tuple, str] = {}
    errors: list[Exception] = []

    def run_rows(rows: list[dict]) -> None:
        table = "/".join(str(rows[0][k]) for k in table_by or keys)
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", table)
        for row in rows:
            name = tuple(row[k] for k in keys)
            try:
                outcome[name] = run_one(row)
            except Exception as error:
                log.exception("run of %s failed", name)
                errors.append(error)
                return

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        # Each run inherits a copy of the caller's local properties, to which it adds its pool.
        runs = [pool.submit(inheritable_thread_target(spark)(run_rows), rows) for rows in tables.values()]
        for run in runs:
            run.result()
    if outcome:
        control = read_keyed(spark, control_path)
        ran = spark.createDataFrame([list(name) for name in outcome], control.select(*keys).schema)
        changed = update_where(pending(control, **due).join(ran, list(keys), "left_semi"), F.lit(True), done)
        write_keyed(changed, control_path, keys, dedup=True, replace=True)
    if errors:
        raise errors[0]
    return outcome
