"""The same results in plain SQL over the same tables, written independently of the operators."""

from __future__ import annotations

CDC = """
cdc AS (
  SELECT user_id, ts, event_id, event_type, value, props,
         CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op
  FROM events)"""

LOGS = (
    CDC
    + """,
log AS (SELECT * FROM cdc WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'),
late_log AS (SELECT * FROM cdc WHERE ts >= TIMESTAMP '2024-01-14 00:00:00'),
cur AS (
  SELECT user_id, event_type, value, props, ts AS effective_from, nx AS effective_to,
         CASE WHEN nx IS NULL THEN 'active' ELSE 'inactive' END AS status
  FROM (SELECT *, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx
        FROM cdc WHERE ts < TIMESTAMP '2024-01-15 00:00:00') h),
act AS (SELECT * FROM cur WHERE status = 'active'),
fc AS (SELECT user_id, MIN(ts) AS first_change FROM log GROUP BY user_id),
closed AS (
  SELECT a.user_id, a.event_type, a.value, a.props, a.effective_from,
         fc.first_change AS effective_to, 'inactive' AS status
  FROM act a JOIN fc ON a.user_id = fc.user_id),
newv AS (
  SELECT user_id, event_type, value, props, ts AS effective_from, nx AS effective_to,
         CASE WHEN nx IS NULL THEN 'active' ELSE 'inactive' END AS status, op
  FROM (SELECT *, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx FROM log) l),
newrows AS (SELECT user_id, event_type, value, props, effective_from, effective_to, status FROM newv),
newkept AS (SELECT user_id, event_type, value, props, effective_from, effective_to, status FROM newv WHERE op <> 'D'),
untouched AS (
  SELECT c.* FROM cur c
  WHERE c.status <> 'active' OR NOT EXISTS (SELECT 1 FROM fc WHERE fc.user_id = c.user_id)),
snap AS (SELECT * FROM untouched UNION ALL SELECT * FROM closed UNION ALL SELECT * FROM newrows),
snap_op AS (SELECT * FROM untouched UNION ALL SELECT * FROM closed UNION ALL SELECT * FROM newkept),
timely AS (
  SELECT l.* FROM late_log l LEFT JOIN act a ON l.user_id = a.user_id
  WHERE a.user_id IS NULL OR l.ts > a.effective_from)"""
)

KINDS = """
kinds AS (
  SELECT CASE WHEN event_type IN ('view', 'click') THEN 'busy' ELSE event_type END AS kind,
         user_id, value, ts, event_id
  FROM events)"""

ORDERS = """
old_orders AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice, 1 AS ver FROM orders
  WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'),
new_orders AS (
  SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice, 2 AS ver FROM orders
  WHERE o_orderdate >= TIMESTAMP '1999-07-01 00:00:00'),
upserted AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice, ver FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY ver DESC) AS rn
    FROM (SELECT * FROM old_orders UNION ALL SELECT * FROM new_orders) u) r
  WHERE rn = 1)"""

CONTROL = """
ctl AS (
  SELECT o_orderkey AS id, o_orderpriority AS batch_name,
         CONCAT('t', CAST(o_custkey AS VARCHAR)) AS table_name,
         CAST(o_orderdate AS DATE) AS business_date,
         CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS step_index,
         'R' AS status, CAST(NULL AS TIMESTAMP) AS updated_at
  FROM orders),
cfg AS (
  SELECT '1-URGENT' AS owner, CONCAT('t', CAST(c_custkey AS VARCHAR)) AS tab,
         CONCAT('daily_', LOWER(c_mktsegment)) AS target
  FROM customer)"""

FEED = (
    CDC
    + """,
feed AS (
  SELECT user_id, event_id, event_type, value, props, op, ts + INTERVAL 8 HOUR AS hk FROM cdc),
w1 AS (SELECT * FROM feed WHERE hk BETWEEN TIMESTAMP '1970-01-01 00:00:00' AND TIMESTAMP '2024-01-15 00:00:00'),
w2 AS (SELECT * FROM feed
       WHERE hk BETWEEN TIMESTAMP '2024-01-15 00:00:00.000001' AND TIMESTAMP '2024-12-31 00:00:00'),
l1 AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY hk DESC, event_id DESC) AS rn
       FROM w1) r WHERE rn = 1 AND op <> 'D'),
l2 AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY hk DESC, event_id DESC) AS rn
       FROM w2) r WHERE rn = 1),
done1 AS (SELECT 'erp' AS source_system, 'job-2024-01-15' AS job_id, DATE '2024-01-15' AS load_date,
                 TIMESTAMP '2024-02-01 08:00:00' AS updated_at),
done2 AS (SELECT 'erp' AS source_system, 'job-2024-02-01' AS job_id, DATE '2024-02-01' AS load_date,
                 TIMESTAMP '2024-02-01 08:00:00' AS updated_at)"""
)


def _first_row(table: str, columns: str, key: str, order: str) -> str:
    return f"""
SELECT {columns} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {table}) r
WHERE rn = 1"""


def _with(prelude: str, body: str) -> str:
    return f"WITH {prelude.strip()}\n{body.strip()}"


USER_COLUMNS = "user_id, event_id, ts, event_type, value, props"

ORACLE = {
    "scan_csv": "SELECT * FROM events",
    "scan_parquet": "SELECT * FROM lineitem",
    "scan_json": "SELECT * FROM orders",
    "scan_orc": "SELECT * FROM orders",
    "scan_text": "SELECT props AS value FROM events",
    "scan_xml": "SELECT * FROM customer",
    "scan_keyed": "SELECT * FROM customer",
    "table_select_where": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
    "sql_param_query": """
SELECT o_orderpriority, COUNT(*) AS n_orders, MAX(o_totalprice) AS max_price
FROM orders WHERE o_totalprice > 1000.0 AND o_orderstatus <> 'P' GROUP BY o_orderpriority""",
    "file_manifest": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows, TRUE AS has_bytes FROM {t}"
        for t in (
            "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
            "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
        )
    ),
    "sink_csv_roundtrip": "SELECT * FROM lineitem",
    "sink_parquet_roundtrip": "SELECT * FROM lineitem",
    "sink_partitioned": "SELECT * FROM lineitem",
    "sink_overwrite_partitions": """
SELECT * REPLACE (CASE WHEN l_returnflag = 'R' OR l_linestatus = 'O' THEN -l_quantity ELSE l_quantity END AS l_quantity)
FROM lineitem WHERE NOT (l_returnflag = 'R' OR l_linestatus = 'O') OR l_linenumber <= 3""",
    "catalog_table_roundtrip": """
SELECT * FROM customer
UNION ALL
SELECT CAST(-1 AS BIGINT), 'O''Hara "quoted"', CAST(NULL AS INTEGER), CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR)""",
    "keyed_append": _with(ORDERS, "SELECT * FROM old_orders UNION ALL SELECT * FROM new_orders"),
    "keyed_upsert": _with(ORDERS, "SELECT * FROM upserted"),
    "keyed_upsert_buckets": _with(
        ORDERS,
        """
SELECT o_orderkey,
       CASE WHEN ver = 2 AND o_orderkey % 500 = 0 THEN 'Y' ELSE o_orderstatus END AS o_orderstatus, o_totalprice,
       CAST(CASE WHEN ver = 2 AND o_orderkey % 500 = 0 THEN 3 ELSE ver END AS INTEGER) AS ver
FROM upserted""",
    ),
    "keyed_upsert_slices": _with(
        ORDERS,
        """
SELECT o_orderkey,
       CASE WHEN ver = 2 AND o_orderkey = 500 THEN 'Y' ELSE o_orderstatus END AS o_orderstatus, o_totalprice,
       CAST(CASE WHEN ver = 2 AND o_orderkey = 500 THEN 3 ELSE ver END AS INTEGER) AS ver
FROM upserted""",
    ),
    "keyed_upsert_partitioned": _with(ORDERS, "SELECT * FROM upserted"),
    "rename_columns": """
SELECT o_orderkey AS order_id, o_totalprice AS total, * EXCLUDE (o_orderkey, o_totalprice) FROM orders""",
    "rename_swap": "SELECT * REPLACE (l_suppkey AS l_partkey, l_partkey AS l_suppkey) FROM lineitem",
    "replace_values": "SELECT "
    + ", ".join(
        [f"CAST(CASE WHEN {c} = 1 THEN 100 ELSE {c} END AS {kind}) AS {c}" for c, kind in (
            ("l_orderkey", "BIGINT"), ("l_partkey", "BIGINT"), ("l_suppkey", "BIGINT"), ("l_linenumber", "INTEGER"),
            ("l_quantity", "DOUBLE"), ("l_extendedprice", "DOUBLE"), ("l_discount", "DOUBLE"), ("l_tax", "DOUBLE"),
        )]
        + [f"CASE {c} WHEN 'A' THEN 'N' WHEN 'N' THEN 'A' WHEN 'F' THEN NULL ELSE {c} END AS {c}" for c in (
            "l_returnflag", "l_linestatus",
        )]
        + ["l_shipdate"]
    )
    + " FROM lineitem",
    "replace_values_subset": """
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus,
       o_orderpriority
FROM orders""",
    "add_column": """
SELECT *, l_extendedprice * (1 - l_discount) AS net, 'erp' AS source
FROM lineitem""",
    "add_audit_columns": _with(
        CDC,
        """
SELECT user_id, ts + INTERVAL 8 HOUR AS ts, event_id, event_type, value, props, op,
       'job-1' AS job_id, TIMESTAMP '2024-02-01 08:00:00' AS updated_at,
       ts + INTERVAL 8 HOUR AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to,
       DATE '2024-01-31' AS load_date, 'active' AS status, 'erp' AS source_system
FROM cdc""",
    ),
    "drop_columns": "SELECT event_id, ts, user_id, event_type FROM events",
    "cast_columns": """
SELECT * REPLACE (TRY_CAST(event_type AS INTEGER) AS event_type), user_id AS user_text,
       CAST(ts AS DATE) AS day, ts AS parsed
FROM events""",
    "shift_timezone": """
SELECT event_id, ts + INTERVAL 8 HOUR AS hk_ts, CAST(NULL AS TIMESTAMP) AS nothing FROM events""",
    "fill_null_keys": """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'unknown' ELSE event_type END AS kind,
       CASE WHEN event_type = 'view' THEN 0 ELSE user_id END AS user_id,
       CASE WHEN event_type = 'click' THEN TIMESTAMP '1900-01-01 00:00:00' ELSE ts END AS ts
FROM events""",
    "filter_between": """
SELECT event_id, ts FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-10 00:00:00'""",
    "filter_not_deleted": _with(CDC, "SELECT event_id, op FROM cdc WHERE op <> 'D'"),
    "is_nonempty": """
SELECT '1997' AS test, COUNT(*) > 0 AS nonempty FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-12-31 00:00:00'
UNION ALL
SELECT '1901', COUNT(*) > 0 FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '1901-01-01 00:00:00' AND TIMESTAMP '1901-12-31 00:00:00'
UNION ALL
SELECT 'negative', COUNT(*) > 0 FROM lineitem WHERE l_quantity < 0""",
    "join_semi_touched": _with(
        LOGS, "SELECT * FROM act WHERE user_id IN (SELECT user_id FROM log WHERE op <> 'D')"
    ),
    "join_anti_untouched": """
SELECT c_custkey AS o_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'F' AND o_custkey = c_custkey)""",
    "join_inner_keys": _with(
        LOGS,
        """
SELECT a.user_id, a.event_type, a.effective_from, fc.first_change
FROM act a JOIN fc ON a.user_id = fc.user_id""",
    ),
    "join_left_keys": """
SELECT d.*, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "union_by_name": """
SELECT c_name AS name, c_custkey AS id, c_acctbal AS balance, CAST(NULL AS INTEGER) AS nation FROM customer
UNION ALL
SELECT s_name, s_suppkey, CAST(NULL AS DOUBLE), s_nationkey FROM supplier""",
    "count_rows": "SELECT COUNT(*) AS n_rows FROM lineitem",
    "control_left_join": _with(
        CONTROL,
        """
SELECT c.id, c.batch_name, c.table_name, f.target AS target_table_name
FROM ctl c LEFT JOIN cfg f ON c.batch_name = f.owner AND c.table_name = f.tab
WHERE c.step_index = 1 AND c.status = 'R'""",
    ),
    "control_pending_count": _with(
        CONTROL, "SELECT COUNT(*) AS n_jobs FROM ctl WHERE step_index = 1 AND status = 'R'"
    ),
    "control_update": _with(
        CONTROL,
        """
SELECT id, batch_name, table_name, business_date,
       CASE WHEN step_index = 1 AND batch_name = '1-URGENT' THEN 2 ELSE step_index END AS step_index,
       status,
       CASE WHEN step_index = 1 AND batch_name = '1-URGENT'
            THEN TIMESTAMP '2024-02-01 08:00:00' ELSE updated_at END AS updated_at
FROM ctl""",
    ),
    "keep_last_events": _first_row("events", USER_COLUMNS, "user_id", "ts DESC, event_id DESC"),
    "keep_last_orders": _first_row(
        "orders", "* EXCLUDE (rn)", "o_custkey", "o_orderdate DESC, o_orderkey DESC"
    ),
    "keep_last_conversations": _first_row(
        "conversations", "conv_id, turn, role, text", "conv_id", "turn DESC, role DESC, text DESC"
    ),
    "keep_first_events": _first_row("events", USER_COLUMNS, "user_id", "ts, event_id"),
    "row_number_per_key": """
SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n
FROM orders""",
    "row_number_hot_key": """
SELECT *, ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_partkey, l_suppkey) AS n
FROM lineitem""",
    "row_number_ties": """
SELECT l_orderkey, l_linenumber, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS n
FROM lineitem""",
    "lead_hot_key": _with(
        KINDS, "SELECT *, LEAD(value) OVER (PARTITION BY kind ORDER BY ts, event_id) AS next_value FROM kinds"
    ),
    "lead_next_change": """
SELECT user_id, event_id, ts, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts FROM events""",
    "cdc_log": _with(LOGS, "SELECT * FROM log"),
    "scd2_current": _with(LOGS, "SELECT * FROM cur"),
    "scd2_initial": _with(
        LOGS,
        _first_row(
            "cdc",
            "user_id, event_type, value, props, ts AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, "
            "'active' AS status",
            "user_id",
            "ts DESC, event_id DESC",
        )
        + " AND op <> 'D'",
    ),
    "scd2_first_change": _with(LOGS, "SELECT * FROM fc"),
    "scd2_closed": _with(LOGS, "SELECT * FROM closed"),
    "scd2_new_versions": _with(LOGS, "SELECT * FROM newrows"),
    "scd2_delta": _with(LOGS, "SELECT * FROM closed UNION ALL SELECT * FROM newrows"),
    "scd2_delta_deletes": _with(LOGS, "SELECT * FROM closed UNION ALL SELECT * FROM newkept"),
    "scd2_delta_on_time": _with(
        LOGS,
        """
SELECT a.user_id, a.event_type, a.value, a.props, a.effective_from, t.ended AS effective_to, 'inactive' AS status
FROM act a JOIN (SELECT user_id, MIN(ts) AS ended FROM timely GROUP BY user_id) t ON a.user_id = t.user_id
UNION ALL
SELECT user_id, event_type, value, props, ts, nx, CASE WHEN nx IS NULL THEN 'active' ELSE 'inactive' END
FROM (SELECT *, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx FROM timely) n""",
    ),
    "scd2_snapshot": _with(LOGS, "SELECT * FROM snap"),
    "scd2_snapshot_deletes": _with(LOGS, "SELECT * FROM snap_op"),
    "scd2_as_of": _with(
        LOGS,
        """
SELECT * FROM snap
WHERE effective_from <= TIMESTAMP '2024-01-20 00:00:00'
  AND (effective_to IS NULL OR effective_to > TIMESTAMP '2024-01-20 00:00:00')""",
    ),
    "scd2_late_rows": _with(
        LOGS, "SELECT l.* FROM late_log l JOIN act a ON l.user_id = a.user_id WHERE l.ts <= a.effective_from"
    ),
    "scd2_snapshot_hot_key": _with(
        KINDS,
        """
SELECT kind, user_id, value, event_id, ts AS effective_from, nx AS effective_to,
       CASE WHEN nx IS NULL THEN 'active' ELSE 'inactive' END AS status
FROM (SELECT *, LEAD(ts) OVER (PARTITION BY kind ORDER BY ts, event_id) AS nx FROM kinds) k""",
    ),
    "scd2_delta_hot_key_on_time": _with(
        KINDS,
        """,
old AS (SELECT * FROM kinds WHERE ts < TIMESTAMP '2024-01-15 00:00:00'),
act AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY kind ORDER BY ts DESC, event_id DESC) AS rn FROM old) o
        WHERE rn = 1),
timely AS (
  SELECT k.* FROM kinds k LEFT JOIN act a ON k.kind = a.kind
  WHERE k.ts >= TIMESTAMP '2024-01-14 00:00:00' AND (a.kind IS NULL OR k.ts > a.ts))
SELECT kind, user_id, value, event_id, ts AS effective_from, nx AS effective_to,
       CASE WHEN nx IS NULL THEN 'active' ELSE 'inactive' END AS status
FROM (SELECT *, LEAD(ts) OVER (PARTITION BY kind ORDER BY ts, event_id) AS nx FROM timely) t
UNION ALL
SELECT a.kind, a.user_id, a.value, a.event_id, a.ts, t.ended, 'inactive'
FROM act a JOIN (SELECT kind, MIN(ts) AS ended FROM timely GROUP BY kind) t ON a.kind = t.kind""".lstrip(),
    ),
    "history_table_ties": """
SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       l_shipdate, l_linenumber AS effective_from, nx AS effective_to,
       CASE WHEN nx IS NULL THEN 'active' ELSE 'inactive' END AS status
FROM (SELECT *, LEAD(l_linenumber) OVER (PARTITION BY l_orderkey
                 ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS nx
      FROM (SELECT * FROM lineitem
            UNION ALL
            SELECT * REPLACE (-1 - l_orderkey AS l_orderkey) FROM lineitem WHERE l_linenumber <= 3) u) l""",
    "processed_to_structured_ties": """
WITH feed AS (
  SELECT * REPLACE (CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS l_shipdate)
  FROM lineitem
  UNION ALL
  SELECT * REPLACE (-1 - l_partkey AS l_partkey,
                    CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) + INTERVAL 60 YEAR AS l_shipdate)
  FROM lineitem WHERE l_linenumber = 1),
runs AS (
  SELECT *, CASE WHEN l_shipdate <= TIMESTAMP '1998-01-01 00:00:00' THEN DATE '1998-01-02'
                 WHEN l_shipdate <= TIMESTAMP '2050-01-01 00:00:00' THEN DATE '2050-01-02'
                 ELSE DATE '2090-01-02' END AS day,
         LEAD(l_shipdate) OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey) AS nx
  FROM feed)
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate AS effective_from, nx AS effective_to,
       CASE WHEN nx IS NULL THEN 'active' ELSE 'inactive' END AS status, 'erp' AS source_system,
       CONCAT('job-', CAST(day AS VARCHAR)) AS job_id, day AS load_date, TIMESTAMP '2024-02-01 00:00:00' AS updated_at,
       CASE WHEN nx IS NULL THEN day
            WHEN nx <= TIMESTAMP '1998-01-01 00:00:00' THEN DATE '1998-01-02'
            WHEN nx <= TIMESTAMP '2050-01-01 00:00:00' THEN DATE '2050-01-02'
            ELSE DATE '2090-01-02' END AS business_date
FROM runs""",
    "scd2_table": _with(LOGS, "SELECT * FROM snap_op"),
    "scd2_late_insert": _with(
        CDC,
        """
SELECT * EXCLUDE (ts, op, nx), ts AS effective_from, nx AS effective_to,
       CASE WHEN nx IS NULL THEN 'active' ELSE 'inactive' END AS status
FROM (SELECT *, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx FROM cdc) h WHERE op <> 'D'""",
    ),
    "zone_copy": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, TRUE AS has_source FROM orders""",
    "zone_archive": "SELECT * FROM events",
    "landing_to_processed": _with(
        CDC,
        """
SELECT user_id, ts + INTERVAL 8 HOUR AS ts, event_id, event_type, value, props, op,
       'job-2024-01-15' AS job_id, TIMESTAMP '2024-02-01 08:00:00' AS updated_at,
       CAST(ts + INTERVAL 8 HOUR AS DATE) AS change_date
FROM cdc""",
    ),
    "processed_to_structured_initial": _with(
        FEED,
        """
SELECT user_id, event_id, event_type, value, props, hk AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to,
       'active' AS status, source_system, job_id, load_date, updated_at, DATE '2024-01-15' AS business_date
FROM l1 CROSS JOIN done1""",
    ),
    "processed_to_structured": _with(
        FEED,
        """
SELECT l1.user_id, l1.event_id, l1.event_type, l1.value, l1.props, l1.hk AS effective_from, l2.hk AS effective_to,
       CASE WHEN l2.hk IS NULL THEN 'active' ELSE 'inactive' END AS status,
       source_system, job_id, load_date, updated_at,
       CASE WHEN l2.hk IS NULL THEN DATE '2024-01-15' ELSE DATE '2024-02-01' END AS business_date
FROM l1 CROSS JOIN done1 LEFT JOIN l2 ON l1.user_id = l2.user_id
UNION ALL
SELECT user_id, event_id, event_type, value, props, hk, CAST(NULL AS TIMESTAMP), 'active',
       source_system, job_id, load_date, updated_at, DATE '2024-02-01'
FROM l2 CROSS JOIN done2 WHERE op <> 'D'""",
    ),
    "processed_to_structured_all": _with(
        FEED,
        """
SELECT user_id, event_id, event_type, value, props, hk AS effective_from, nx AS effective_to,
       CASE WHEN nx IS NULL THEN 'active' ELSE 'inactive' END AS status, source_system,
       CASE WHEN first THEN 'job-2024-01-15' ELSE 'job-2024-02-01' END AS job_id,
       CASE WHEN first THEN DATE '2024-01-15' ELSE DATE '2024-02-01' END AS load_date,
       updated_at,
       CASE WHEN first AND (nx IS NULL OR nx <= TIMESTAMP '2024-01-15 00:00:00')
            THEN DATE '2024-01-15' ELSE DATE '2024-02-01' END AS business_date
FROM (SELECT *, hk <= TIMESTAMP '2024-01-15 00:00:00' AS first,
             LEAD(hk) OVER (PARTITION BY user_id ORDER BY hk, event_id) AS nx FROM feed) f
CROSS JOIN done1 WHERE op <> 'D'""",
    ),
    "control_run": """
SELECT event_type AS table_name, user_id, event_id, value, hk AS effective_from, nx AS effective_to,
       CASE WHEN nx IS NULL THEN 'active' ELSE 'inactive' END AS status,
       DATE '2024-02-01' AS business_date, 2 AS step_index, TIMESTAMP '2024-02-01 08:00:00' AS done_at
FROM (SELECT *, ts + INTERVAL 8 HOUR AS hk,
             LEAD(ts + INTERVAL 8 HOUR) OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS nx
      FROM events WHERE event_type <> 'view') e""",
    "stream_ingest_files": """
SELECT event_id, ts + INTERVAL 8 HOUR AS ts, user_id, event_type, value, props,
       'job-1' AS job_id, TIMESTAMP '2024-02-01 08:00:00' AS updated_at
FROM events""",
    "stream_upsert_events": _first_row("events", USER_COLUMNS, "user_id", "ts DESC, event_id DESC"),
    "zone_archive_manifest": """
SELECT event_id, event_type, place FROM events, (SELECT unnest(['backup', 'processed']) AS place)""",
    "stream_scd2_users": _with(LOGS, "SELECT * FROM snap"),
}
