"""Type-2 history: versions of a key with status, start and end.

A current table holds business columns plus status, start and end. A change log
holds the business columns, one or more ordering columns and, optionally, an
operation code. Each change opens a version at its first ordering column and
closes the one before it.

The merge tags active rows 0 and changes 1, unions them and takes the next
start per key: one shuffle by key and no join. Rows that no change can touch
stay out of that shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import RESERVED, as_column, as_list, col, quoted, resolve, same_schema
from tidemark.operators.filters import not_deleted
from tidemark.operators.hotkeys import find_cuts
from tidemark.operators.joins import join_grouped, rows_untouched
from tidemark.operators.latest import content_hash, keep_last, lead_in_key

_NEW = RESERVED + "new"
_START = RESERVED + "start"
_NEXT = RESERVED + "next"
_GONE = RESERVED + "gone"
_SINCE = RESERVED + "since"
_END = RESERVED + "end"


@dataclass(frozen=True)
class History:
    """Column names and rules of a history table.

    ts          ordering columns of the log; the first one gives start and end
    tie_breaker further ordering columns for changes at the same instant
    op          operation column; a delete closes a version and opens none.
                Without it every change opens a version
    late        "apply" takes changes that are not newer than the active
                version as they come, "drop" leaves them out (see late_rows),
                "insert" puts them in their place: the version that holds the
                instant is cut there, ended or not, so the order in which changes
                arrive does not matter. Such a history keeps its tie-breakers,
                which must tell all changes of a key apart, and its deletes, as
                rows of status `removed` that are valid at no time
    unique_order  ts and tie_breaker tell all changes of a key apart; otherwise
                changes at one place go by their content
    hot_keys    False states that no key holds a large share of the changes
    """

    keys: list[str] | str
    ts: list[str] | str
    tie_breaker: list[str] | str = field(default_factory=list)
    op: str | None = None
    deleted: str = "D"
    status: str = "status"
    start: str = "effective_from"
    end: str = "effective_to"
    active: str = "active"
    inactive: str = "inactive"
    removed: str = "removed"
    late: str = "apply"
    unique_order: bool = False
    hot_keys: bool = True

    def __post_init__(self):
        for name in ("keys", "ts", "tie_breaker"):
            object.__setattr__(self, name, as_list(getattr(self, name)))
        if not self.keys or not self.ts:
            raise ValueError("keys and ts must name at least one column each")
        if self.late not in ("apply", "drop", "insert"):
            raise ValueError(f"late must be apply, drop or insert, not {self.late}")
        if self.late == "insert" and len(self.ts) > 1:
            raise ValueError("late='insert' orders by one column of ts: name the others as tie_breaker")

    @property
    def own(self) -> set[str]:
        return {self.status.lower(), self.start.lower(), self.end.lower()}

    def record_keys(self, versions: DataFrame) -> list[str]:
        """What identifies one version: key, start, and the tie-breakers that the table keeps."""
        there = {c.lower() for c in versions.columns}
        return [*self.keys, self.start, *[t for t in self.tie_breaker if t.lower() in there]]

    def schema(self, log: DataFrame, drop: Iterable[str] = ()) -> T.StructType:
        """Schema of a history built from `log`: its business columns plus the history's own.

        Tie-breakers stay: versions that start at one instant are told apart by them.
        """
        ts = log.schema[resolve(log, self.ts[0])[0]].dataType
        gone = {c.lower() for c in [*self.ts, *([self.op] if self.op else []), *drop]}
        gone = (gone | self.own) - {k.lower() for k in self.keys}
        fields = [f for f in log.schema if f.name.lower() not in gone]
        return T.StructType(
            [
                *fields,
                T.StructField(self.start, ts),
                T.StructField(self.end, ts),
                T.StructField(self.status, T.StringType()),
            ]
        )


def _active(current: DataFrame, spec: History) -> DataFrame:
    return current.filter(col(spec.status) == spec.active)


def checked_key(name: str) -> Column:
    """The key itself; a NULL stops the query, since it would never match its versions."""
    message = f"NULL in key {name} of the change log: use fill_null_keys first"
    return F.coalesce(col(name), F.raise_error(F.lit(message)))


def _checked(log: DataFrame, spec: History) -> DataFrame:
    return log.withColumns({k: checked_key(k) for k in resolve(log, spec.keys)})


def _changes(log: DataFrame, schema: T.StructType, spec: History) -> DataFrame:
    """Changes as versions to be: business columns by name, start, order and delete flag."""
    business = T.StructType([f for f in schema if f.name.lower() not in spec.own])
    order = resolve(log, spec.ts + spec.tie_breaker)
    gone = F.lit(False)
    if spec.op is not None:
        gone = col(resolve(log, spec.op)[0]).eqNullSafe(spec.deleted)
    keys = {k.lower() for k in spec.keys}
    names = resolve(log, [f.name for f in business])
    # Changes that the order does not tell apart go by their content.
    ties = [] if spec.unique_order else [content_hash(log).alias(f"{RESERVED}o{len(order)}")]
    return log.select(
        *[
            (checked_key(n) if n.lower() in keys else col(n)).cast(f.dataType).alias(f.name)
            for n, f in zip(names, business)
        ],
        F.lit(1).alias(_NEW),
        col(order[0]).alias(_START),
        gone.alias(_GONE),
        *[col(o).alias(f"{RESERVED}o{i}") for i, o in enumerate(order)],
        *ties,
    )


def _merge(active: DataFrame | None, log: DataFrame, schema: T.StructType, spec: History) -> DataFrame:
    """Active versions and changes, each with the start of the key's next version."""
    keys = [f.name for f in schema if f.name.lower() in {k.lower() for k in spec.keys}]
    if len(keys) != len(spec.keys):
        raise ValueError(f"keys {spec.keys} must all be columns of the history")
    order = [f"{RESERVED}o{i}" for i in range(len(spec.ts + spec.tie_breaker) + (not spec.unique_order))]
    rows = _changes(log, schema, spec)
    cuts = find_cuts(rows, keys, order) if spec.hot_keys else None
    if active is None:
        return lead_in_key(rows, keys, [_NEW, *order], _START, _NEXT, cuts, order)
    before = active.select(
        *[col(f.name) for f in schema if f.name.lower() not in spec.own],
        F.lit(0).alias(_NEW),
        col(spec.start).alias(_START),
        F.lit(False).alias(_GONE),
    )
    if spec.late == "drop":
        rows = _newer_than_active(rows, before, keys)
    rows = before.unionByName(rows, allowMissingColumns=True)
    return lead_in_key(rows, keys, [_NEW, *order], _START, _NEXT, cuts, order)


def _newer_than_active(rows: DataFrame, active: DataFrame, keys: list[str]) -> DataFrame:
    starts = active.groupBy(*[col(k) for k in keys]).agg(F.max(_START).alias(_SINCE))
    joined = join_grouped(rows, starts, keys, "left")
    return joined.filter(F.col(_SINCE).isNull() | (F.col(_START) > F.col(_SINCE))).select("l.*")


def _as_versions(merged: DataFrame, schema: T.StructType, spec: History) -> DataFrame:
    """Merged rows in the table's schema; deletes have closed their version and go, or stay as such."""
    status = F.when(F.col(_NEXT).isNull(), F.lit(spec.active)).otherwise(F.lit(spec.inactive))
    end = F.col(_NEXT)
    if spec.late == "insert":
        status = F.when(F.col(_GONE), F.lit(spec.removed)).otherwise(status)
        end = F.when(F.col(_GONE), F.col(_START)).otherwise(end)
    else:
        merged = merged.filter(~F.col(_GONE))
    own = {spec.start.lower(): F.col(_START), spec.end.lower(): end, spec.status.lower(): status}
    return merged.select(
        *[own.get(f.name.lower(), col(f.name)).cast(f.dataType).alias(f.name) for f in schema]
    )


def _recut(current: DataFrame, log: DataFrame, spec: History) -> DataFrame:
    """What changes put at their instants add to a history and change in it, by version.

    Of each key, the versions from the one that holds its first change on are met,
    found by a range of their ends, and get their ends anew.
    """
    schema = current.schema
    business = [f.name for f in schema if f.name.lower() not in spec.own]
    keys, ties = resolve(current, spec.keys), resolve(current, spec.tie_breaker)
    (start,), (end,) = resolve(current, spec.start), resolve(current, spec.end)
    new = _changes(log, schema, spec).select(
        *map(col, business), F.col(_START).cast(schema[start].dataType).alias(_START), _GONE,
        F.lit(None).cast(schema[end].dataType).alias(_END), F.lit(1).alias(_NEW),
    )
    stored = current.select(
        *map(col, business), col(start).alias(_START), col(spec.status).eqNullSafe(spec.removed).alias(_GONE),
        col(end).alias(_END), F.lit(0).alias(_NEW),
    )
    since = new.groupBy(*map(col, keys)).agg(F.min(_START).alias(_SINCE))
    met = join_grouped(stored, since, keys).filter(F.col(_END).isNull() | (F.col(_END) >= F.col(_SINCE))).select("l.*")
    # A change that comes again takes the place of what it made before.
    record = [*keys, _START, *ties]
    old = join_grouped(met, new.select(*map(col, record)).distinct(), record, "left_anti", null_safe=True)
    rows, order = old.unionByName(keep_last(new, record, [_START])), [_START, *ties]
    cuts = find_cuts(rows, keys, order) if spec.hot_keys else None
    merged = lead_in_key(rows, keys, order, _START, _NEXT, cuts, order)
    moved = ~F.col(_GONE) & ~F.col(_NEXT).eqNullSafe(F.col(_END))
    return _as_versions(merged.filter((F.col(_NEW) == 1) | moved), schema, spec)


def late_rows(current: DataFrame, log: DataFrame, spec: History) -> DataFrame:
    """Changes that are not newer than the active version of their key."""
    names = resolve(log, spec.keys)
    log = _checked(log, spec)
    starts = (
        _active(current, spec)
        .groupBy(*[col(k).alias(n) for k, n in zip(resolve(current, spec.keys), names)])
        .agg(F.max(col(spec.start)).alias(_SINCE))
    )
    joined = join_grouped(log, starts, names)
    return joined.filter(F.col("l." + quoted(resolve(log, spec.ts[0])[0])) <= F.col(_SINCE)).select("l.*")


def first_change(log: DataFrame, spec: History, name: str = "first_change") -> DataFrame:
    """When the batch first touches each key: the time its active version ends."""
    return _checked(log, spec).groupBy(*[col(k) for k in resolve(log, spec.keys)]).agg(
        F.min(col(resolve(log, spec.ts[0])[0])).alias(name)
    )


def closed_versions(
    current: DataFrame, log: DataFrame, spec: History
) -> DataFrame:
    """Active versions that the batch ends, each once however many changes there are."""
    active = _active(current, spec)
    if spec.late == "insert":
        raise ValueError("late='insert' changes ended versions too: use delta")
    if spec.late == "drop":
        merged = _merge(active, log, current.schema, spec)
        return _as_versions(merged.filter((F.col(_NEW) == 0) & F.col(_NEXT).isNotNull()), current.schema, spec)
    ends = first_change(log, spec, _NEXT)
    names = resolve(current, spec.keys)
    ends = ends.select(*[col(s).alias(n) for s, n in zip(resolve(ends, spec.keys), names)], _NEXT)
    values = {spec.end.lower(): F.col(_NEXT), spec.status.lower(): F.lit(spec.inactive)}
    return active.join(ends, names, "inner").select(
        *[values.get(f.name.lower(), col(f.name)).cast(f.dataType).alias(f.name) for f in current.schema]
    )


def new_versions(
    log: DataFrame, spec: History, schema: T.StructType | None = None
) -> DataFrame:
    """One version per change, ended by the next change of the key."""
    schema = schema or spec.schema(log)
    return _as_versions(_merge(None, log, schema, spec), schema, spec)


def delta(current: DataFrame, log: DataFrame, spec: History) -> DataFrame:
    """What the batch changes: versions it ends and versions it opens.

    Columns are those of `current`, by name; columns only the log has are left
    out. Upserting the result by key and start brings the table up to date.
    With late="insert", `current` must hold the ended versions that the batch meets.
    """
    if spec.late == "insert":
        return _recut(current, log, spec)
    schema = current.schema
    merged = _merge(_active(current, spec), log, schema, spec)
    changed = (F.col(_NEW) == 1) | F.col(_NEXT).isNotNull()
    return _as_versions(merged.filter(changed), schema, spec)


def snapshot(current: DataFrame, log: DataFrame, spec: History) -> DataFrame:
    """The whole table after the batch: past versions, untouched ones and the delta."""
    if spec.late == "insert":
        changed = _recut(current, log, spec)
        return rows_untouched(current, changed, spec.record_keys(current), null_safe=True).unionByName(changed)
    schema = current.schema
    rest = current.filter(~col(spec.status).eqNullSafe(spec.active))
    active = _active(current, spec)
    merged = _merge(active, log, schema, spec)
    return rest.unionByName(_as_versions(merged, schema, spec))


def initial_load(log: DataFrame, spec: History, schema: T.StructType | None = None) -> DataFrame:
    """First version of each key: its newest change, unless that is a delete."""
    schema = schema or spec.schema(log)
    last = keep_last(log, spec.keys, spec.ts + spec.tie_breaker, unique_order=bool(spec.tie_breaker))
    if spec.op is not None:
        last = not_deleted(last, spec.op, spec.deleted)
    (ts,) = resolve(log, spec.ts[0])
    own = {spec.start: col(ts), spec.end: F.lit(None), spec.status: F.lit(spec.active)}
    types = {f.name.lower(): f.dataType for f in schema}
    return same_schema(last.withColumns({n: v.cast(types[n.lower()]) for n, v in own.items()}), schema)


def as_of(history: DataFrame, moment, spec: History) -> DataFrame:
    """Versions valid at `moment`: started by then and not ended yet."""
    moment = as_column(moment).cast(history.schema[resolve(history, spec.start)[0]].dataType)
    return history.filter(
        (col(spec.start) <= moment) & (col(spec.end).isNull() | (col(spec.end) > moment))
    )
