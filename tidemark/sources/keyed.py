"""Keyed tables: catalog tables of Spark that are appended to and upserted by key.

A table is parquet, partitioned by columns of the caller's choice and by a hash of
the keys (`key_slice`), and bucketed and sorted by the keys within. An upsert
writes its batch once, in the same buckets, so it joins the batch with the stored
rows without shuffling either, and replaces whole partitions by Spark's dynamic
partition overwrite: those that hold a key of the batch, no others. Any Spark
session reads the table, and any tool its folders.

A table is named as in the catalog, or by a path (anything with a slash). A path
is a table of its own in the session's catalog, below a folder that says how many
buckets and slices it has, so that another session finds the same layout.

A write is one or two Spark writes. Before the first one the table's properties
say that its keys may repeat, after the last one that they do not; so what an
interrupted upsert has left is put right by the next one, which then looks at
every partition. There is one writer at a time, and readers read again after it.
"""

from __future__ import annotations

import hashlib
import json
import re
import threading
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import RESERVED, all_of, as_list, col, quoted, resolve, same_schema
from tidemark.operators.latest import keep_last
from tidemark.session import shared_dir, size_shuffles
from tidemark.sources.paths import child_names, file_system, folder_bytes

SLICE = "key_slice"
ID = "commit_id"  # partition of one append: its number, and the batch it is of
SEQ = "commit_seq"
_BATCH = RESERVED + "batch"
_COLUMNS, _KEYS, _BY, _UNIQUE, _WRITES, _SEEN = (
    f"tidemark.{name}" for name in ("columns", "keys", "by", "unique", "writes", "batch.")
)
_DURING_WRITES = {
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A table bucketed by some of its keys is joined on all of them without a shuffle.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Batches that lie bucketed are written bucket by bucket, also where no join asks for it.
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}
_writing: dict[str, tuple[int, dict[str, str | None]]] = {}
_lock = threading.Lock()


@contextmanager
def _settings(spark: SparkSession) -> Iterator[None]:
    """The session's settings during writes, which may overlap in several threads."""
    session = str(id(spark._jsparkSession))
    with _lock:
        if session not in _writing:
            _writing[session] = (0, {name: spark.conf.get(name, None) for name in _DURING_WRITES})
            for name, value in _DURING_WRITES.items():
                spark.conf.set(name, value)
        _writing[session] = (_writing[session][0] + 1, _writing[session][1])
    try:
        yield
    finally:
        with _lock:
            writes, before = _writing.pop(session)
            if writes > 1:
                _writing[session] = (writes - 1, before)
            else:
                for name, value in before.items():
                    spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _is_path(table: str) -> bool:
    return "/" in table


def catalog_name(table: str) -> str:
    """The table's name in the catalog; that of a path is made from the path."""
    if not _is_path(table):
        return table
    return f"keyed_{hashlib.sha256(table.rstrip('/').encode()).hexdigest()[:24]}"


def _layout_folder(spark: SparkSession, path: str) -> str | None:
    """The folder below a path that holds its rows, named after buckets and slices."""
    found = [n for n in child_names(spark, path) if re.fullmatch(r"rows-\d+-\d+", n)]
    return f"{path.rstrip('/')}/{found[0]}" if found else None


def table_exists(spark: SparkSession, table: str) -> bool:
    """Whether the table has been written; one whose first write failed before any row has not."""
    name = catalog_name(table)
    if spark.catalog.tableExists(name):
        written = int(_properties(spark, name)[_WRITES]) > 0
        return written or not spark.sql(f"SHOW PARTITIONS {name}").isEmpty()
    return _is_path(table) and _layout_folder(spark, table) is not None


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _set(spark: SparkSession, name: str, properties: dict[str, str]) -> None:
    pairs = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def _create(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    keys: list[str],
    parts: list[str],
    by: list[str],
    buckets: int,
    slices: int,
    append: bool,
) -> None:
    name, location = catalog_name(table), None
    if _is_path(table):
        location = _layout_folder(spark, table) or f"{table.rstrip('/')}/rows-{buckets}-{slices}"
        buckets, slices = map(int, location.rsplit("/", 1)[1].split("-")[1:])
    fields = [T.StructField(f.name, f.dataType) for f in schema]
    fields += [T.StructField(SLICE, T.IntegerType())] + ([T.StructField(ID, T.StringType())] if append else [])
    folders = [*parts, SLICE, *([ID] if append else [])]
    listed = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
    inside = [c for c in by if c.lower() not in {p.lower() for p in parts}]
    text = f"CREATE TABLE {name} ({listed}) USING parquet PARTITIONED BY ({', '.join(map(quoted, folders))})"
    if buckets and inside:
        columns = ", ".join(map(quoted, inside))
        text += f" CLUSTERED BY ({columns}) SORTED BY ({columns}) INTO {buckets} BUCKETS"
    if location:
        text += f" LOCATION {_text(location)}"
    properties = {
        _COLUMNS: json.dumps(schema.names), _KEYS: json.dumps(keys), _BY: json.dumps([by, slices, buckets if inside else 0]),
        _UNIQUE: "false", _WRITES: "0",
    }
    pairs = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())
    spark.sql(f"{text} TBLPROPERTIES ({pairs})")
    if location and child_names(spark, location):  # rows of another session
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


class _Stored:
    """What the catalog knows of a table."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.name = spark, catalog_name(table)
        self.properties = _properties(spark, self.name)
        self.schema = spark.table(self.name).schema
        self.columns: list[str] = json.loads(self.properties[_COLUMNS])
        self.keys: list[str] = json.loads(self.properties[_KEYS])
        self.by, self.slices, self.buckets = json.loads(self.properties[_BY])
        self.folders = [c.name for c in spark.catalog.listColumns(self.name) if c.isPartition]
        self.append = ID in self.folders
        self.parts = [c for c in self.folders if c not in (SLICE, ID)]
        self.unique = self.properties[_UNIQUE] == "true"

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def plain(self) -> T.StructType:
        types = {f.name: f for f in self.schema}
        return T.StructType([types[c] for c in self.columns])

    def bucketed_by(self) -> list[str]:
        return [c for c in self.by if c.lower() not in {p.lower() for p in self.parts}]

    def slice_of(self) -> Column:
        return F.pmod(F.xxhash64(*[col(k) for k in self.by]), F.lit(self.slices)).cast("int").alias(SLICE)

    def partitions(self) -> DataFrame:
        return self.spark.sql(f"SHOW PARTITIONS {self.name}")

    def next_write(self) -> int:
        last = int(self.properties[_WRITES])
        if self.append:
            number = F.regexp_extract("partition", rf"(?:^|/){ID}=(\d+)", 1).cast("int")
            last = max(last, self.partitions().agg(F.max(number)).first()[0] or 0)
        return last + 1

    def has_batch(self, source: str, number: int) -> bool:
        if int(self.properties.get(_SEEN + source, -1)) >= number:
            return True
        if not self.append:
            return False
        # A table found by its path knows appended batches by their folders.
        return not self.partitions().filter(F.col("partition").endswith(f"-{source}-{number}")).isEmpty()

    def done(self, write: int, unique: bool, batch_id: tuple[str, int] | None) -> int:
        seen = {_SEEN + batch_id[0]: str(batch_id[1])} if batch_id else {}
        _set(self.spark, self.name, {_UNIQUE: str(unique).lower(), _WRITES: str(write), **seen})
        return write


def read_keyed(spark: SparkSession, table: str, with_seq: bool = False) -> DataFrame:
    """Current rows of a keyed table; filters on its partition columns leave out whole folders.

    `with_seq` adds the number of the append that wrote the row, an ordering column
    for rows with equal change times. Read again after the table has been written.
    """
    name = catalog_name(table)
    if spark.catalog.tableExists(name):
        stored = _Stored(spark, table)
        number = [F.regexp_extract(ID, r"^\d+", 0).cast("int").alias(SEQ)] if with_seq else []
        return stored.rows().select(*[col(c) for c in stored.columns], *number)
    folder = _layout_folder(spark, table) if _is_path(table) else None
    if folder is None:
        raise FileNotFoundError(f"no keyed table {table}")
    df = spark.read.parquet(folder)
    number = [F.regexp_extract(F.col(ID).cast("string"), r"^\d+", 0).cast("int").alias(SEQ)] if with_seq else []
    return df.select("*", *number).drop(SLICE, ID)


def _equal(folders: list[str], row) -> Column:
    return all_of([col(c).eqNullSafe(F.lit(row[c])) for c in folders])


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _of(df: DataFrame, folders: list[str], values: list) -> DataFrame:
    """Rows of the given partitions, by conditions that leave out the others' folders."""
    return df.filter(_any([_equal(folders, v) for v in values]))


def _prunes(batch: DataFrame, stored: _Stored) -> list[int]:
    """Slices of the batch's keys; at most as many as the table has."""
    return [r[0] for r in batch.select(stored.slice_of()).distinct().collect()]


def _newer(order: list[str], replace: bool) -> Column:
    """Whether the batch's row "r" takes the place of the stored row "l" of its key, if there is one."""
    there = F.col(f"l.{_BATCH}").isNotNull()
    if replace or not order:
        return F.lit(True)
    left, right = (F.struct(*[F.col(f"{side}.{quoted(c)}") for c in order]) for side in "lr")
    return ~there | (right >= left)


def _whole(keys: list[str]) -> Column:
    return all_of([col(k).isNotNull() for k in keys])


def _joined(old: DataFrame, batch: DataFrame, keys: list[str], how: str, nulls: bool) -> DataFrame:
    """Stored rows "l" and the batch's rows "r" by key, each with _BATCH where there is one.

    With `nulls`, keys with a NULL match each other, but in a join of their own:
    the join of all others does not move stored rows that are bucketed by their keys.
    """
    old, batch = (df.withColumn(_BATCH, F.lit(1)) for df in (old, batch))
    pairs = [(F.col(f"l.{quoted(k)}"), F.col(f"r.{quoted(k)}")) for k in keys]
    same = [all_of([a == b for a, b in pairs]), all_of([a.eqNullSafe(b) for a, b in pairs])]
    sides = [(old, batch)]
    if nulls:
        sides = [(old.filter(c), batch.filter(c)) for c in (_whole(keys), ~_whole(keys))]
    both = [
        left.alias("l").join(right.alias("r"), on, how).select(F.struct("l.*").alias("l"), F.struct("r.*").alias("r"))
        for (left, right), on in zip(sides, same)
    ]
    return reduce(DataFrame.unionByName, both)


def merged(
    old: DataFrame, batch: DataFrame, keys: list[str], order: list[str], replace: bool, nulls: bool = True
) -> DataFrame:
    """One row per key of stored and new rows, the newer one; the batch wins where the order does not decide.

    Both sides have one row per key; `nulls` tells whether the batch may have keys with a NULL.
    """
    new = F.col(f"r.{_BATCH}").isNotNull() & _newer(order, replace)
    sides = [(F.col(f"r.{quoted(c)}"), F.col(f"l.{quoted(c)}"), c) for c in old.columns]
    return _joined(old, batch, keys, "full_outer", nulls).select(*[F.when(new, r).otherwise(l).alias(c) for r, l, c in sides])


def _winners(
    old: DataFrame, batch: DataFrame, keys: list[str], order: list[str], replace: bool, nulls: bool
) -> DataFrame:
    """The batch's rows that are in the merged table; reads keys and order of the stored ones only."""
    if replace or not order:
        return batch
    names = [col(c) for c in dict.fromkeys([*keys, *order])]
    joined = _joined(old.select(*names), batch, keys, "right", nulls).filter(_newer(order, replace))
    return joined.select("r.*").drop(_BATCH)


def _met(
    old: DataFrame, batch: DataFrame, stored: _Stored, keys: list[str], near: Sequence[Column], nulls: bool
) -> list:
    """Partitions that hold a key of the batch; reads key columns only."""
    names, own = dict.fromkeys([*keys, *stored.folders]), batch.select(*map(col, keys))
    # One scan per condition: each then skips partitions and row groups on its own.
    scans = [old.filter(condition) for condition in near] or [old]
    found = [_joined(s.select(*map(col, names)), own, keys, "inner", nulls) for s in scans]
    folders = [F.col(f"l.{quoted(c)}") for c in stored.folders]
    return reduce(DataFrame.union, [f.select(*folders) for f in found]).distinct().collect()


def _drop_partition(stored: _Stored, row, files: list[str]) -> None:
    """Leave a partition out of the catalog, and delete the files it had."""
    pairs = [(quoted(c), "null" if row[c] is None else _text(str(row[c]))) for c in stored.folders]
    spec = ", ".join(f"{c} = {value}" for c, value in pairs)
    stored.spark.sql(f"ALTER TABLE {stored.name} DROP IF EXISTS PARTITION ({spec})")
    for file in files:  # those of a table with a location of its own are not deleted by the catalog
        fs, path = file_system(stored.spark, unquote(file))
        fs.delete(path, False)


def _insert(df: DataFrame, stored: _Stored, overwrite: bool) -> None:
    rows = df.select(*[col(f.name) for f in stored.schema])
    if stored.buckets and not overwrite:
        # Each task then writes one bucket.
        rows = rows.repartition(stored.buckets, *map(col, stored.bucketed_by()))
    rows.write.insertInto(stored.name, overwrite=overwrite)


def _batch_table(stored: _Stored) -> str:
    return f"keyed_batch_{hashlib.sha256(stored.name.encode()).hexdigest()[:24]}"


def _written(batch: DataFrame, stored: _Stored, folder: str) -> DataFrame:
    """The batch, written once; in the buckets of the stored rows, if they have any."""
    spark = stored.spark
    if not stored.buckets:
        batch.write.parquet(folder)
        return spark.read.schema(batch.schema).parquet(folder)
    inside, name = resolve(batch, stored.bucketed_by()), _batch_table(stored)
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # of an upsert that was interrupted
    rows = batch.repartition(stored.buckets, *map(col, inside))
    rows.write.bucketBy(stored.buckets, *inside).saveAsTable(name, format="parquet", path=folder)
    return spark.table(name)


def write_keyed(
    df: DataFrame,
    table: str,
    keys: str | Iterable[str],
    order_by: str | Iterable[str | Column] = (),
    partition_by: str | Iterable[str] = (),
    dedup: bool = False,
    replace: bool = False,
    known_unique: bool = False,
    near: Sequence[Column] = (),
    batch_id: tuple[str, int] | None = None,
    buckets: int = 0,
    slices: int = 1,
    bucket_by: str | Iterable[str] = (),
) -> int | None:
    """Write a batch to a keyed table, made by the first write; returns the number of the write.

    dedup=False    append all rows as they are
    dedup=True     upsert: one row per key, the newest by `order_by` stays;
                   on a tie the batch replaces the stored row. Sort expressions in
                   `order_by` need `replace`
    replace        upsert in which `order_by` only decides within the batch,
                   and the batch replaces stored rows whatever their order
    known_unique   the caller states that the batch has one row per key (and,
                   when appending to a new table, that the table is unique then)
    near           upsert: conditions; every stored row that shares a key with the
                   batch meets one of them, and others are not even looked at
    buckets        buckets of a new table by its keys, or by `bucket_by`, some of
                   them; as many as upserts shall have tasks. By default those of the
                   session's shuffles for upserted tables, and none for appended ones
    slices         parts of the keys by their hash that are folders of their own:
                   an upsert reads and rewrites those of its own keys only
    batch_id       (source, number): a batch already written is skipped and
                   None returned, which makes retries of a stream harmless

    An upsert rewrites the partitions that hold a key of the batch and adds to
    others. Null partition values, empty batches and keys with NULLs are as any
    others; columns go by name, and names the table lacks are refused.
    """
    spark = df.sparkSession
    keys, parts = resolve(df, keys), resolve(df, partition_by)
    order_by = as_list(order_by) if isinstance(order_by, str) else list(order_by)
    by = resolve(df, bucket_by) or keys
    if {SEQ, ID, SLICE} & {c.lower() for c in df.columns}:
        raise ValueError(f"{SEQ}, {ID} and {SLICE} are reserved column names")
    if not set(by) <= set(keys):
        raise ValueError("bucket_by must name keys")
    if dedup and not replace and any(isinstance(c, Column) for c in order_by):
        raise ValueError("an upsert compares columns: give order_by as names")
    name = catalog_name(table)
    if not spark.catalog.tableExists(name):
        buckets = buckets or (int(spark.conf.get("spark.sql.shuffle.partitions")) if dedup else 0)
        _create(spark, table, df.schema, keys, parts, by, buckets, slices, append=not dedup)
        new = spark.sql(f"SHOW PARTITIONS {name}").isEmpty()
    else:
        new = False
    stored = _Stored(spark, table)
    if as_list(partition_by) and [p.lower() for p in parts] != [p.lower() for p in stored.parts]:
        raise ValueError(f"table {table} is partitioned by {stored.parts}")
    extra = {c.lower() for c in df.columns} - {c.lower() for c in stored.columns}
    if extra:
        raise ValueError(f"table {table} has no column {sorted(extra)}")
    df = same_schema(df, stored.plain())
    keys = resolve(df, keys)
    if batch_id is not None and stored.has_batch(*batch_id):
        return None
    write = stored.next_write()
    label = "-".join([f"{write:010d}", *([batch_id[0], str(batch_id[1])] if batch_id else [])])
    with _settings(spark):
        if not dedup:
            rows = df.withColumn(SLICE, stored.slice_of())
            if stored.append:
                # The append's own partitions: written again by a retry, not twice.
                rows = rows.withColumn(ID, F.lit(label))
            # Whether or not an append is told to be unique, stored rows may share its keys.
            unique = known_unique and (new or stored.unique)
            _set(spark, name, {_UNIQUE: "false"})
            _insert(rows, stored, overwrite=stored.append)
            return stored.done(write, unique, batch_id)
        batch = df if known_unique else keep_last(df, keys, order_by)
        if new:
            _insert(batch.withColumn(SLICE, stored.slice_of()), stored, overwrite=False)
            return stored.done(write, True, batch_id)
        _upsert(batch, stored, keys, order_by, replace, near, label)
        return stored.done(write, True, batch_id)


def _upsert(
    batch: DataFrame, stored: _Stored, keys: list[str], order_by: list, replace: bool, near: Sequence[Column], label: str
) -> None:
    """Merge a batch with one row per key into the partitions that hold its keys."""
    spark = stored.spark
    order = [] if replace else resolve(batch, order_by)
    # The batch is read several times: write it once, whatever it took to make it.
    folder = shared_dir(spark, "batch")
    try:
        batch = _written(batch.withColumn(SLICE, stored.slice_of()), stored, folder)
        size_shuffles(spark, folder_bytes(spark, folder))
        nulls = not batch.filter(~_whole(keys)).isEmpty()
        old = stored.rows()
        unique = stored.unique and [k.lower() for k in stored.keys] == [k.lower() for k in keys]
        if stored.slices > 1 and unique:
            own = _prunes(batch, stored)
            old = old.filter(F.col(SLICE).isin(own)) if own else old.limit(0)
        if unique:
            met = _met(old, batch, stored, keys, near, nulls)
        else:  # every row of a key is found, and the newest kept
            met = old.select(*map(col, stored.folders)).distinct().collect()
        old = _of(old, stored.folders, met)
        before = set(old.inputFiles())
        if not unique:
            old = keep_last(old, keys, order_by)
        _set(spark, stored.name, {_UNIQUE: "false"})
        if stored.append:  # all rows of the partitions met become rows of this write
            old, batch = (df.withColumn(ID, F.lit(label)) for df in (old, batch))
            _insert(merged(old, batch, keys, order, replace, nulls), stored, overwrite=True)
        else:
            # New rows of other partitions first: no version of a row is ever missing.
            inside = _any([_equal(stored.folders, v) for v in met])
            _insert(_winners(old, batch.filter(~inside), keys, order, replace, nulls), stored, overwrite=False)
            if met:
                _insert(merged(old, batch, keys, order, replace, nulls).filter(inside), stored, overwrite=True)
        # A partition that came to have no row was not written, so it still has its files.
        if before & set(_of(stored.rows(), stored.folders, met).inputFiles()):
            for row in met:
                files = before & set(_of(stored.rows(), stored.folders, [row]).inputFiles())
                if files:
                    _drop_partition(stored, row, sorted(files))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {_batch_table(stored)}")
        fs, written = file_system(spark, folder)
        fs.delete(written.getParent(), True)
