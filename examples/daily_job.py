"""Daily job: every table the control table lists as due, from landing to structured.

    spark-submit examples/daily_job.py LAKE JOB_ID

Below LAKE:

    control        keyed table: batch_name, table_name, business_date, job_id, start_time,
                   from_time, to_time, step_index, status, status_desc, updated_at
    config         parquet: owner, source_table, target, primary_key, source_schema
    landing/<batch>/<table>      files with the table's columns, op and changed_at (UTC)
    backup, processed, structured, bookmarks      made by the job
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark.functions.times import run_time, timestamp_literal  # noqa: E402
from tidemark.plans.control import run_pending  # noqa: E402
from tidemark.plans.daily import Zones, run_table  # noqa: E402
from tidemark.plans.zones import Run  # noqa: E402
from tidemark.session import get_session  # noqa: E402

CONTROL_KEYS = ["batch_name", "table_name", "business_date"]


def run_day(spark: SparkSession, lake: str, job_id: str, run_ts: str | None = None) -> dict[tuple, str]:
    job_columns = {"job_id": job_id, "updated_at": lambda: run_time(run_ts)}

    def run_one(job: dict) -> str:
        name = f"{job['batch_name']}/{job['table_name']}".lower()
        zones = Zones(
            landing=f"{lake}/landing/{name}",
            processed=f"{lake}/processed/{name}",
            structured=f"{lake}/structured/{name}",
            bookmark=f"{lake}/bookmarks/{name}",
            backup=f"{lake}/backup/{name}",
        )
        run = Run(
            keys=job["primary_key"],
            ts_col="changed_at",
            op_col="op",
            window_from=job["from_time"],
            window_to=job["to_time"],
            business_date=str(job["business_date"]),
            landed_with=job_columns,
            versions_with={
                **job_columns,
                "load_date": lambda: timestamp_literal(job["start_time"]).cast("date"),
                "source_system": job["source_schema"],
            },
        )
        return run_table(spark, zones, run)

    return run_pending(
        spark,
        f"{lake}/control",
        run_one,
        CONTROL_KEYS,
        due={"job_id": job_id, "step_index": 1, "status": "R"},
        done={"step_index": 2, "status": "R", "status_desc": "Ready", "updated_at": lambda: run_time(run_ts)},
        table_by=["batch_name", "table_name"],
        config=spark.read.parquet(f"{lake}/config"),
        on={"batch_name": "owner", "table_name": "source_table"},
    )


if __name__ == "__main__":
    session = get_session("daily job")
    for table, outcome in run_day(session, sys.argv[1].rstrip("/"), sys.argv[2]).items():
        print(*table, outcome)
    session.stop()
