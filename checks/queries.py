"""Every operator as a query over the given tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import HONG_KONG, null_timestamp, parse_timestamp, run_time, shift_timezone
from tidemark.operators import columns, filters, history, joins, latest
from tidemark.operators.history import History
from tidemark.plans import control, landing, zones
from tidemark.plans.daily import Zones, run_table
from tidemark.plans.history_table import merge_history, write_versions
from tidemark.session import apply_defaults, shared_dir
from tidemark.sources import catalog, files, keyed
from tidemark.streaming import ingest

CUT = "2024-01-15 00:00:00"
RUN_TS = "2024-02-01 00:00:00"
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]

# Events are spread evenly over users; KINDS below has a key that is not.
EVEN = {"ts": "ts", "tie_breaker": "event_id", "unique_order": True, "hot_keys": False}
USERS = History(keys="user_id", **EVEN)
USERS_OP = History(keys="user_id", op="op", **EVEN)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return apply_defaults(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# Change feed: events as changes of a user.


def cdc(spark, sf_dir) -> DataFrame:
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    events = table(spark, sf_dir, "events")
    return events.withColumn("op", op)


def user_log(spark, sf_dir) -> DataFrame:
    return cdc(spark, sf_dir).filter(F.col("ts") >= F.lit(CUT).cast("timestamp_ntz"))


def late_log(spark, sf_dir) -> DataFrame:
    return cdc(spark, sf_dir).filter(F.col("ts") >= F.lit("2024-01-14 00:00:00").cast("timestamp_ntz"))


def user_schema(log: DataFrame) -> T.StructType:
    return USERS.schema(log, drop=["op", "event_id"])


def user_history(spark, sf_dir) -> DataFrame:
    """The table before the batch: all versions from changes before the cut."""
    before = cdc(spark, sf_dir).filter(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))
    return history.new_versions(before, USERS, user_schema(before))


# Scans and sinks.


def _round_trip(fmt: str, name: str, **options):
    def run(spark, sf_dir):
        df = table(spark, sf_dir, name)
        path = shared_dir(spark, fmt)
        files.write_files(df, fmt, path, **options)
        return files.read_files(spark, fmt, path, df.schema, **options)

    return run


def scan_parquet(spark, sf_dir):
    apply_defaults(spark)
    return files.read_parquet(spark, f"{sf_dir}/lineitem.parquet")


def scan_text(spark, sf_dir):
    path = shared_dir(spark, "text")
    files.write_files(table(spark, sf_dir, "events").select("props"), "text", path)
    return files.read_files(spark, "text", path)


def scan_keyed(spark, sf_dir):
    path = shared_dir(spark, "customer")
    df = table(spark, sf_dir, "customer")
    keyed.write_keyed(df, path, "c_custkey", partition_by="c_mktsegment", known_unique=True)
    return keyed.read_keyed(spark, path)


def table_select_where(spark, sf_dir):
    name = f"orders_{uuid4().hex}"
    table(spark, sf_dir, "orders").createTempView(name)
    return catalog.select_table(spark, name, ["o_orderkey", "o_totalprice"], "o_orderstatus = 'F'")


def sql_param_query(spark, sf_dir):
    return catalog.run_sql(
        spark,
        """SELECT o_orderpriority, COUNT(*) AS n_orders, MAX(o_totalprice) AS max_price
           FROM {orders} WHERE o_totalprice > :floor AND o_orderstatus <> :skip GROUP BY o_orderpriority""",
        {"floor": 1000.0, "skip": "P"},
        orders=table(spark, sf_dir, "orders"),
    )


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def file_manifest(spark, sf_dir):
    """Files of each table by listing, with the rows read from them."""
    name = F.regexp_extract("path", r"([a-z]+)\.parquet", 1)
    listed = files.file_manifest(spark, sf_dir, "*.parquet").select(
        name.alias("table_name"), F.regexp_extract("path", "[^/]+$", 0).alias("file_name"), "length"
    )
    counts = [
        table(spark, sf_dir, t)
        .groupBy(F.lit(t).alias("table_name"), F.col("_metadata.file_name").alias("file_name"))
        .agg(F.count("*").alias("n"))
        for t in TABLES
    ]
    found = joins.join_on_keys(listed, reduce(DataFrame.unionByName, counts), ["table_name", "file_name"])
    return found.groupBy("table_name").agg(F.sum("n").alias("n_rows"), (F.min("length") > 0).alias("has_bytes"))


def sink_partitioned(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    path = shared_dir(spark, "lineitem")
    files.write_files(df, "parquet", path, partition_by=["l_returnflag", "l_linestatus"])
    return files.read_parquet(spark, path, df.schema).select(*df.columns)


def sink_overwrite_partitions(spark, sf_dir):
    """Two of the partitions are run again, from the folder itself; the others stay as they were."""
    df = table(spark, sf_dir, "lineitem")
    path = shared_dir(spark, "lineitem")
    files.write_files(df, "parquet", path, partition_by=["l_returnflag", "l_linestatus"])
    again = files.read_parquet(spark, path, df.schema).filter("l_returnflag = 'R' OR l_linestatus = 'O'")
    again = again.filter("l_linenumber <= 3").withColumn("l_quantity", -F.col("l_quantity"))
    files.write_files(again, "parquet", path, "overwrite_partitions", ["l_returnflag", "l_linestatus"])
    return files.read_parquet(spark, path, df.schema).select(*df.columns)


def catalog_table_roundtrip(spark, sf_dir):
    df = table(spark, sf_dir, "customer")
    database = f"tidemark_{uuid4().hex}"
    catalog.create_database(spark, database, shared_dir(spark, "db"))
    columns_text = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    catalog.create_table(spark, f"{database}.customer", columns_text)
    catalog.create_table(spark, f"{database}.other", columns_text)
    catalog.drop_table(spark, f"{database}.other")
    catalog.insert_rows(df.select(*reversed(df.columns)), f"{database}.customer")
    catalog.insert_values(
        spark, f"{database}.customer", ["c_custkey", "c_name", "c_nationkey"], [-1, "O'Hara \"quoted\"", None]
    )
    return catalog.select_table(spark, f"{database}.customer")


def _order_batches(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    old = orders.filter("o_orderdate < timestamp_ntz'2000-01-01'").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.lit(1).alias("ver")
    )
    new = orders.filter("o_orderdate >= timestamp_ntz'1999-07-01'").select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), "o_totalprice", F.lit(2).alias("ver")
    )
    return old, new


def keyed_append(spark, sf_dir):
    path = shared_dir(spark, "orders")
    for batch in _order_batches(spark, sf_dir):
        keyed.write_keyed(batch, path, "o_orderkey", "ver", dedup=False)
    return keyed.read_keyed(spark, path)


def keyed_upsert(spark, sf_dir):
    path = shared_dir(spark, "orders")
    for batch in _order_batches(spark, sf_dir):
        keyed.write_keyed(batch, path, "o_orderkey", "ver", dedup=True)
    return keyed.read_keyed(spark, path)


def keyed_upsert_buckets(spark, sf_dir):
    """The table is laid out by key; three batches, the last with few keys."""
    path = shared_dir(spark, "orders")
    old, new = _order_batches(spark, sf_dir)
    few = new.filter("o_orderkey % 500 = 0").withColumns({"o_orderstatus": F.lit("Y"), "ver": F.lit(3)})
    for batch in (old, new, few):
        keyed.write_keyed(batch, path, "o_orderkey", "ver", dedup=True, buckets=16)
    return keyed.read_keyed(spark, path)


def keyed_upsert_slices(spark, sf_dir):
    """Slices of keys are folders of their own; the last batch meets one of them."""
    path = shared_dir(spark, "orders")
    old, new = _order_batches(spark, sf_dir)
    few = new.filter("o_orderkey = 500").withColumns({"o_orderstatus": F.lit("Y"), "ver": F.lit(3)})
    for batch in (old, new, few):
        keyed.write_keyed(batch, path, "o_orderkey", "ver", dedup=True, buckets=4, slices=5)
    return keyed.read_keyed(spark, path)


def keyed_upsert_partitioned(spark, sf_dir):
    """The second batch moves rows to another partition and meets only some folders."""
    path = shared_dir(spark, "orders")
    for batch in _order_batches(spark, sf_dir):
        keyed.write_keyed(batch, path, "o_orderkey", "ver", partition_by="o_orderstatus", dedup=True)
    return keyed.read_keyed(spark, path)


# Projections.


def rename_columns(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    return columns.rename_columns(df, {"o_orderkey": "order_id", "O_TOTALPRICE": "total", "absent": "x"})


def rename_swap(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return columns.rename_columns(df, {"l_partkey": "l_suppkey", "l_suppkey": "l_partkey"})


def replace_values(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return columns.replace_values(df, {"A": "N", "N": "A", "F": None, 1: 100})


def replace_values_subset(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return columns.replace_values(df, {"F": "finished", "O": "open"}, subset="o_orderstatus")


def add_column(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    df = columns.add_column(df, "net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return columns.add_column(df, "source", "erp")


def _job(name: str, zone: str = HONG_KONG) -> dict:
    return {"job_id": name, "updated_at": lambda: run_time(RUN_TS, zone)}


def _audit(day: str, zone: str = HONG_KONG) -> dict:
    """What a run puts on landed rows and on versions."""
    job = _job(f"job-{day}", zone)
    versions = {**job, "load_date": date.fromisoformat(day), "source_system": "erp"}
    return {"landed_with": job, "versions_with": versions}


def add_audit_columns(spark, sf_dir):
    df = columns.landing_columns(cdc(spark, sf_dir), "ts", _job("job-1"))
    return columns.version_columns(df, "ts", {"load_date": date(2024, 1, 31), "source_system": "erp", **_job("job-1")})


def drop_columns(spark, sf_dir):
    return columns.drop_columns(table(spark, sf_dir, "events"), ["props", "VALUE", "absent"])


def cast_columns(spark, sf_dir):
    df = table(spark, sf_dir, "events").withColumns(
        {"user_text": F.col("user_id").cast("string"), "day": F.col("ts")}
    )
    df = columns.cast_columns(df, {"event_type": "int", "user_text": "bigint", "day": "date"})
    return df.withColumn("parsed", parse_timestamp(F.col("ts").cast("string")))


def shift_timezone_query(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    return df.select("event_id", shift_timezone(F.col("ts")).alias("hk_ts"), null_timestamp().alias("nothing"))


def fill_null_keys(spark, sf_dir):
    df = table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("kind"),
        F.when(F.col("event_type") != "view", F.col("user_id")).alias("user_id"),
        F.when(F.col("event_type") != "click", F.col("ts")).alias("ts"),
    )
    return columns.fill_null_keys(df, ["kind", "user_id", "ts"], {"kind": "unknown"})


# Filters, joins, aggregates, union.


def filter_between(spark, sf_dir):
    df = filters.in_window(table(spark, sf_dir, "events"), "ts", "2024-01-05 00:00:00", "2024-01-10 00:00:00")
    return df.select("event_id", "ts")


def filter_not_deleted(spark, sf_dir):
    return filters.not_deleted(cdc(spark, sf_dir)).select("event_id", "op")


def is_nonempty(spark, sf_dir):
    """Windows of shipping dates, and an amount that cannot be: is there any line item?"""
    lines = table(spark, sf_dir, "lineitem")
    windows = [("1997", "1997-01-01", "1997-12-31"), ("1901", "1901-01-01", "1901-12-31")]
    rows = [(name, filters.is_nonempty(filters.in_window(lines, "l_shipdate", a, b))) for name, a, b in windows]
    rows.append(("negative", filters.is_nonempty(lines.filter("l_quantity < 0"))))
    return spark.createDataFrame(rows, "test string, nonempty boolean")


def join_semi_touched(spark, sf_dir):
    current = user_history(spark, sf_dir).filter("status = 'active'")
    return joins.rows_touched(current, filters.not_deleted(user_log(spark, sf_dir)), "user_id")


def join_anti_untouched(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return joins.rows_untouched(customers, orders, "o_custkey")


def join_inner_keys(spark, sf_dir):
    first = history.first_change(user_log(spark, sf_dir), USERS)
    current = user_history(spark, sf_dir).filter("status = 'active'")
    return joins.join_on_keys(current, first, "user_id").select(
        "user_id", "event_type", "effective_from", "first_change"
    )


def join_left_keys(spark, sf_dir):
    return joins.join_on_keys(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id", "left")


def union_by_name(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )
    return joins.union_by_name(customers, suppliers, allow_missing=True)


def count_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n_rows"))


# Control table: one row per order as a job of its customer's table.


DUE = {"step_index": 1, "status": "R"}
DONE = {"step_index": 2, "status": "R", "updated_at": lambda: run_time(RUN_TS)}


def control_rows(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("batch_name"),
        F.concat(F.lit("t"), F.col("o_custkey").cast("string")).alias("table_name"),
        F.col("o_orderdate").cast("date").alias("business_date"),
        F.when(F.col("o_orderstatus") == "F", 2).otherwise(1).alias("step_index"),
        F.lit("R").alias("status"),
        null_timestamp().alias("updated_at"),
    )


def config_rows(spark, sf_dir):
    """One configuration per customer's table, for one of the batches."""
    return table(spark, sf_dir, "customer").select(
        F.lit("1-URGENT").alias("owner"),
        F.concat(F.lit("t"), F.col("c_custkey").cast("string")).alias("tab"),
        F.concat(F.lit("daily_"), F.lower("c_mktsegment")).alias("target"),
    )


def control_left_join(spark, sf_dir):
    due = control.pending(control_rows(spark, sf_dir), step_index=1, status="R")
    rows = control.with_config(due, config_rows(spark, sf_dir), {"batch_name": "owner", "table_name": "tab"})
    return rows.select("id", "batch_name", "table_name", F.col("target").alias("target_table_name"))


def control_pending_count(spark, sf_dir):
    return control.pending_count(control_rows(spark, sf_dir), step_index=1, status="R")


def control_update(spark, sf_dir):
    match = (F.col("step_index") == 1) & (F.col("batch_name") == "1-URGENT")
    return control.update_where(control_rows(spark, sf_dir), match, DONE)


# Order within a key.


def keep_last_events(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    return latest.keep_last(df, "user_id", ["ts", "event_id"], unique_order=True)


def keep_last_orders(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    return latest.keep_last(df, "o_custkey", [F.desc("o_orderdate"), F.desc("o_orderkey")], unique_order=True)


def keep_last_conversations(spark, sf_dir):
    """Last turn of each conversation, whole text."""
    df = table(spark, sf_dir, "conversations")
    return latest.keep_last(df, "conv_id", ["turn", "role", "text"], unique_order=True)


def keep_first_events(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    return latest.keep_first(df, "user_id", ["ts", "event_id"], unique_order=True)


def row_number_per_key(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    return latest.row_number_per_key(df, "o_custkey", ["o_orderdate", "o_orderkey"], "n", unique_order=True, hot_keys=False)


def row_number_hot_key(spark, sf_dir):
    """Each of the three flags has a third of all rows."""
    df = table(spark, sf_dir, "lineitem")
    return latest.row_number_per_key(df, "l_returnflag", ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey"], "n")


def row_number_ties(spark, sf_dir):
    """Lines of an order by a number that repeats: each number once, whoever gets it among equals."""
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return latest.row_number_per_key(df, "l_orderkey", "l_linenumber", "n")


def lead_hot_key(spark, sf_dir):
    return latest.lead_next(kinds(spark, sf_dir), "kind", ["ts", "event_id"], "value", "next_value", unique_order=True)


def lead_next_change(spark, sf_dir):
    df = cdc(spark, sf_dir).select("user_id", "event_id", "ts")
    return latest.lead_next(
        df, "user_id", ["ts", "event_id"], "ts", "next_ts", unique_order=True, hot_keys=False
    )


# History.


def scd2_initial(spark, sf_dir):
    log = cdc(spark, sf_dir)
    return history.initial_load(log, USERS_OP, user_schema(log))


def scd2_new_versions(spark, sf_dir):
    log = user_log(spark, sf_dir)
    return history.new_versions(log, USERS, user_schema(log))


def _on_history(operator, log=user_log, spec=USERS):
    return lambda spark, sf_dir: operator(user_history(spark, sf_dir), log(spark, sf_dir), spec)


def scd2_first_change(spark, sf_dir):
    return history.first_change(user_log(spark, sf_dir), USERS)


def scd2_as_of(spark, sf_dir):
    whole = history.snapshot(user_history(spark, sf_dir), user_log(spark, sf_dir), USERS)
    return history.as_of(whole, "2024-01-20 00:00:00", USERS)


ON_TIME = History(keys="user_id", late="drop", **EVEN)

# Kinds of events: one has two fifths of all rows, so its windows are cut into slices.
KINDS = History(keys="kind", ts="ts", tie_breaker="event_id", unique_order=True)
KINDS_ON_TIME = History(keys="kind", ts="ts", tie_breaker="event_id", late="drop", unique_order=True)


def kinds(spark, sf_dir) -> DataFrame:
    kind = F.when(F.col("event_type").isin("view", "click"), "busy").otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select(kind.alias("kind"), "user_id", "value", "ts", "event_id")


def _on_kinds(operator, spec, cut):
    def run(spark, sf_dir):
        log = kinds(spark, sf_dir)
        before = F.col("ts") < F.lit(CUT).cast("timestamp_ntz")
        current = history.new_versions(log.filter(before), spec, spec.schema(log))
        return operator(current, log.filter(F.col("ts") >= F.lit(cut).cast("timestamp_ntz")), spec)

    return run


def history_table_ties(spark, sf_dir):
    """Lines as versions of their order: several at one place, told apart by what they are of.

    The third batch holds other keys only and must leave all versions as they are.
    """
    ties = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    spec = History(keys="l_orderkey", ts="l_linenumber", tie_breaker=ties)
    path = shared_dir(spark, "lines")
    lines = table(spark, sf_dir, "lineitem")
    early = F.col("l_linenumber") <= 3
    unrelated = lines.filter(early).withColumn("l_orderkey", -1 - F.col("l_orderkey"))
    for batch in (lines.filter(early), lines.filter(~early), unrelated):
        merge_history(batch, path, spec, stored=True)
    return keyed.read_keyed(spark, path)


def scd2_table(spark, sf_dir):
    """The history kept as a keyed table: stored, then merged with the batch."""
    path = shared_dir(spark, "users")
    write_versions(user_history(spark, sf_dir), path, USERS)
    changed = history.delta(keyed.read_keyed(spark, path), user_log(spark, sf_dir), USERS_OP)
    write_versions(changed, path, USERS, CUT)
    return keyed.read_keyed(spark, path)


def scd2_late_insert(spark, sf_dir):
    """Three deliveries, the middle of the time last: the same versions as from all changes at once."""
    spec = replace(USERS_OP, late="insert")
    feed = cdc(spark, sf_dir)
    path = shared_dir(spark, "users")
    early, late = (F.col("ts") < F.lit(moment).cast("timestamp_ntz") for moment in ("2024-01-08 00:00:00", CUT))
    for batch in (~late, early, ~early & late):
        merge_history(feed.filter(batch), path, spec)
    return keyed.read_keyed(spark, path).filter("status <> 'removed'")


# Zones.


def _run(start: str, end: str, day: str, **more) -> zones.Run:
    return zones.Run(
        keys="user_id",
        ts_col="ts",
        window_from=start,
        window_to=end,
        business_date=day,
        **_audit(day),
        tie_breaker="event_id",
        **more,
    )


FIRST = ("1970-01-01 00:00:00", "2024-01-15 00:00:00", "2024-01-15")
SECOND = ("2024-01-15 00:00:00.000001", "2024-12-31 00:00:00", "2024-02-01")


def zone_copy(spark, sf_dir):
    apply_defaults(spark)
    staging = shared_dir(spark, "staging")
    zones.stage_batch(spark, f"{sf_dir}/supplier.parquet", staging)
    zones.stage_batch(spark, f"{sf_dir}/orders.parquet", staging)
    df = files.read_parquet(spark, staging)
    return df.select(*ORDER_COLUMNS, F.col("source_file").isNotNull().alias("has_source"))


def _landed(spark, sf_dir) -> str:
    path = shared_dir(spark, "processed")
    zones.land(cdc(spark, sf_dir), path, _run(*FIRST))
    return path


def landing_to_processed(spark, sf_dir):
    return keyed.read_keyed(spark, _landed(spark, sf_dir))


def processed_to_structured_initial(spark, sf_dir):
    processed, structured = _landed(spark, sf_dir), shared_dir(spark, "structured")
    zones.structure(spark, processed, structured, _run(*FIRST, op_col="op"))
    return keyed.read_keyed(spark, structured)


def processed_to_structured(spark, sf_dir):
    processed, structured = _landed(spark, sf_dir), shared_dir(spark, "structured")
    for window in (FIRST, SECOND):
        zones.structure(spark, processed, structured, _run(*window, op_col="op"))
    return keyed.read_keyed(spark, structured)


def processed_to_structured_all(spark, sf_dir):
    """Every change a version, not only the newest per batch."""
    processed, structured = _landed(spark, sf_dir), shared_dir(spark, "structured")
    for window in (FIRST, SECOND):
        zones.structure(spark, processed, structured, _run(*window, op_col="op", collapse=False))
    return keyed.read_keyed(spark, structured)


def processed_to_structured_ties(spark, sf_dir):
    """Lines as changes of their part by month: many at one instant, in three runs, one of other parts only."""
    processed, structured = shared_dir(spark, "processed"), shared_dir(spark, "structured")

    def run(start: str, end: str, day: str) -> zones.Run:
        return zones.Run(
            keys="l_partkey", ts_col="l_shipdate", window_from=start, window_to=end, business_date=day,
            tie_breaker=["l_orderkey", "l_linenumber", "l_suppkey"], collapse=False, zone="UTC", **_audit(day, "UTC"),
        )

    first = run("1970-01-01 00:00:00", "1998-01-01 00:00:00", "1998-01-02")
    second = run("1998-01-01 00:00:00.000001", "2050-01-01 00:00:00", "2050-01-02")
    third = run("2050-01-01 00:00:00.000001", "2090-01-01 00:00:00", "2090-01-02")
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.withColumn("l_shipdate", F.date_trunc("month", "l_shipdate").cast("timestamp_ntz"))
    other = lines.filter("l_linenumber = 1").withColumns(
        {"l_partkey": -1 - F.col("l_partkey"), "l_shipdate": F.expr("l_shipdate + INTERVAL 60 YEARS")}
    )
    for step, batch in ((first, lines), (second, None), (third, other)):
        if batch is not None:
            zones.land(batch, processed, step)
        zones.structure(spark, processed, structured, step)
    return keyed.read_keyed(spark, structured)


def control_run(spark, sf_dir):
    """One source table per event type; all but one are due and run through the zones."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    base = shared_dir(spark, "lake")
    files.write_files(events, "parquet", f"{base}/landing", partition_by="event_type")
    rows = events.groupBy(F.col("event_type").alias("table_name")).agg(
        F.when(F.max("event_type") == "view", 2).otherwise(1).alias("step_index"),
        F.lit("R").alias("status"),
        null_timestamp().alias("updated_at"),
    )
    keyed.write_keyed(rows, f"{base}/control", "table_name", known_unique=True)
    run = _run("1970-01-01 00:00:00", "2024-12-31 00:00:00", "2024-02-01", collapse=False)

    def run_one(job: dict) -> str:
        name = job["table_name"]
        paths = [f"{base}/{zone}/{name}" for zone in ("processed", "structured", "bookmarks")]
        return run_table(spark, Zones(f"{base}/landing/event_type={name}", *paths), run)

    done = control.run_pending(spark, f"{base}/control", run_one, ["table_name"], DUE, DONE)
    tables = [
        keyed.read_keyed(spark, f"{base}/structured/{name}").withColumn("table_name", F.lit(name))
        for (name,) in sorted(done)
    ]
    state = keyed.read_keyed(spark, f"{base}/control").select(
        "table_name", "step_index", F.col("updated_at").alias("done_at")
    )
    return joins.join_on_keys(reduce(DataFrame.unionByName, tables), state, "table_name").select(
        "table_name", "user_id", "event_id", "value", "effective_from", "effective_to",
        F.col("status"), "business_date", "step_index", "done_at",
    )


# Streaming.


def _event_stream(spark, sf_dir) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return ingest.new_files(spark, f"{sf_dir}/events.parquet*", schema)


def stream_ingest_files(spark, sf_dir):
    base = shared_dir(spark, "ingest")
    for _ in range(2):
        ingest.append_stream(
            _event_stream(spark, sf_dir),
            f"{base}/processed",
            "event_id",
            f"{base}/bookmark",
            lambda batch: columns.landing_columns(batch, "ts", _job("job-1")),
        )
    return keyed.read_keyed(spark, f"{base}/processed")


def _land_in_parts(spark, sf_dir, landing: str, step) -> None:
    """Events arrive in two deliveries; `step` runs after each."""
    events = table(spark, sf_dir, "events")
    cut = F.col("ts") < F.lit(CUT).cast("timestamp_ntz")
    for part in (events.filter(cut), events.filter(~cut)):
        files.write_parquet(part, landing, mode="append")
        step(ingest.new_files(spark, landing, events.schema))


def stream_upsert_events(spark, sf_dir):
    base = shared_dir(spark, "upsert")
    _land_in_parts(
        spark, sf_dir, f"{base}/landing",
        lambda stream: ingest.upsert_stream(
            stream, f"{base}/users", "user_id", ["ts", "event_id"], f"{base}/bookmark", buckets=8,
        ),
    )
    return keyed.read_keyed(spark, f"{base}/users")


def stream_scd2_users(spark, sf_dir):
    base = shared_dir(spark, "history")
    _land_in_parts(
        spark, sf_dir, f"{base}/landing",
        lambda stream: ingest.history_stream(
            stream, f"{base}/users", USERS, f"{base}/bookmark", buckets=8
        ),
    )
    return keyed.read_keyed(spark, f"{base}/users").drop("event_id")


def zone_archive_manifest(spark, sf_dir):
    """Files taken by a manifest: after each run all are in the backup, the last batch's too."""
    base = shared_dir(spark, "manifest")
    events = table(spark, sf_dir, "events")
    for kind in (F.col("event_type") == "view", F.col("event_type") != "view"):
        files.write_parquet(events.filter(kind), f"{base}/landing", mode="append")
        for _ in range(2):
            landing.take_files(
                spark, f"{base}/landing", f"{base}/files",
                lambda rows, id_: keyed.write_keyed(rows, f"{base}/processed", "event_id", batch_id=id_),
                events.schema, archive=f"{base}/backup",
            )
    moved = files.read_parquet(spark, f"{base}/backup", events.schema, recursiveFileLookup="true")
    left = spark.read.schema(events.schema).parquet(f"{base}/landing")
    places = {"backup": moved, "processed": keyed.read_keyed(spark, f"{base}/processed"), "landing": left}
    return reduce(
        DataFrame.unionByName,
        [df.select("event_id", "event_type", F.lit(place).alias("place")) for place, df in places.items()],
    )


def zone_archive(spark, sf_dir):
    """Each landed row is in exactly one of landing and backup while files move."""
    base = shared_dir(spark, "archive")
    schema = table(spark, sf_dir, "events").schema

    def step(_):
        ingest.append_stream(
            ingest.new_files(spark, f"{base}/landing", schema, archive=f"{base}/backup"),
            f"{base}/processed", "event_id", f"{base}/bookmark",
        )

    _land_in_parts(spark, sf_dir, f"{base}/landing", step)
    backup = files.read_parquet(spark, f"{base}/backup", schema, recursiveFileLookup="true")
    return backup.unionByName(files.read_parquet(spark, f"{base}/landing", schema))


QUERIES = {
    "scan_csv": _round_trip("csv", "events", header="true", **files.EXACT_TIMES),
    "scan_parquet": scan_parquet,
    "scan_json": _round_trip("json", "orders", **files.EXACT_TIMES),
    "scan_orc": _round_trip("orc", "orders"),
    "scan_text": scan_text,
    "scan_xml": _round_trip("xml", "customer", rowTag="customer"),
    "scan_keyed": scan_keyed,
    "table_select_where": table_select_where,
    "sql_param_query": sql_param_query,
    "file_manifest": file_manifest,
    "sink_csv_roundtrip": _round_trip("csv", "lineitem", **files.EXACT_TIMES),
    "sink_parquet_roundtrip": _round_trip("parquet", "lineitem"),
    "sink_partitioned": sink_partitioned,
    "sink_overwrite_partitions": sink_overwrite_partitions,
    "catalog_table_roundtrip": catalog_table_roundtrip,
    "keyed_append": keyed_append,
    "keyed_upsert": keyed_upsert,
    "keyed_upsert_buckets": keyed_upsert_buckets,
    "keyed_upsert_slices": keyed_upsert_slices,
    "keyed_upsert_partitioned": keyed_upsert_partitioned,
    "rename_columns": rename_columns,
    "rename_swap": rename_swap,
    "replace_values": replace_values,
    "replace_values_subset": replace_values_subset,
    "add_column": add_column,
    "add_audit_columns": add_audit_columns,
    "drop_columns": drop_columns,
    "cast_columns": cast_columns,
    "shift_timezone": shift_timezone_query,
    "fill_null_keys": fill_null_keys,
    "filter_between": filter_between,
    "filter_not_deleted": filter_not_deleted,
    "is_nonempty": is_nonempty,
    "join_semi_touched": join_semi_touched,
    "join_anti_untouched": join_anti_untouched,
    "join_inner_keys": join_inner_keys,
    "join_left_keys": join_left_keys,
    "union_by_name": union_by_name,
    "count_rows": count_rows,
    "control_left_join": control_left_join,
    "control_pending_count": control_pending_count,
    "control_update": control_update,
    "keep_last_events": keep_last_events,
    "keep_last_orders": keep_last_orders,
    "keep_last_conversations": keep_last_conversations,
    "keep_first_events": keep_first_events,
    "row_number_per_key": row_number_per_key,
    "row_number_hot_key": row_number_hot_key,
    "row_number_ties": row_number_ties,
    "lead_hot_key": lead_hot_key,
    "lead_next_change": lead_next_change,
    "cdc_log": user_log,
    "scd2_current": user_history,
    "scd2_initial": scd2_initial,
    "scd2_first_change": scd2_first_change,
    "scd2_closed": _on_history(history.closed_versions),
    "scd2_new_versions": scd2_new_versions,
    "scd2_delta": _on_history(history.delta),
    "scd2_delta_deletes": _on_history(history.delta, spec=USERS_OP),
    "scd2_delta_on_time": _on_history(history.delta, late_log, ON_TIME),
    "scd2_snapshot": _on_history(history.snapshot),
    "scd2_snapshot_deletes": _on_history(history.snapshot, spec=USERS_OP),
    "scd2_as_of": scd2_as_of,
    "scd2_late_rows": _on_history(history.late_rows, late_log),
    "scd2_snapshot_hot_key": _on_kinds(history.snapshot, KINDS, CUT),
    "scd2_delta_hot_key_on_time": _on_kinds(history.delta, KINDS_ON_TIME, "2024-01-14 00:00:00"),
    "scd2_table": scd2_table,
    "scd2_late_insert": scd2_late_insert,
    "history_table_ties": history_table_ties,
    "processed_to_structured_ties": processed_to_structured_ties,
    "zone_copy": zone_copy,
    "zone_archive": zone_archive,
    "zone_archive_manifest": zone_archive_manifest,
    "landing_to_processed": landing_to_processed,
    "processed_to_structured_initial": processed_to_structured_initial,
    "processed_to_structured": processed_to_structured,
    "processed_to_structured_all": processed_to_structured_all,
    "control_run": control_run,
    "stream_ingest_files": stream_ingest_files,
    "stream_upsert_events": stream_upsert_events,
    "stream_scd2_users": stream_scd2_users,
}
