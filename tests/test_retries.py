"""Results with tasks that fail on their first attempt; needs a session of its own that retries."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from tidemark.operators import history, hotkeys, latest
from tidemark.operators.history import History
from tidemark.session import apply_defaults, shared_dir
from tidemark.sources.keyed import read_keyed, write_keyed

spark = (
    SparkSession.builder.master("local[4,4]")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.ui.enabled", "false")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
apply_defaults(spark)
events = spark.read.parquet(sys.argv[1] + "/events.parquet").drop("props")
# One user holds half of all rows.
events = events.withColumn("user_id", F.when(F.col("event_id") % 2 == 0, 0).otherwise(F.col("user_id")))


def fail_once(batches):
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("task lost")
    yield from batches


shaky = events.repartition(6, "event_id").mapInPandas(fail_once, events.schema)


def rows(df):
    return sorted(map(str, df.collect()))


spec = History(keys="user_id", ts="ts", tie_breaker="event_id")
for operator in (
    lambda df: latest.keep_last(df.drop("ts"), "user_id", "event_type"),
    lambda df: latest.row_number_per_key(df, "user_id", ["event_type", "event_id"]),
    lambda df: latest.lead_next(df, "user_id", ["ts", "event_id"], "ts"),
    lambda df: history.new_versions(df, spec),
):
    assert rows(operator(shaky)) == rows(operator(events))
path = shared_dir(spark, "retries")
for part in (shaky.filter("event_type <> 'view'"), shaky):
    write_keyed(part, path, "user_id", ["ts", "event_id"], "event_type", dedup=True)
want = latest.keep_last(events, "user_id", ["ts", "event_id"])
assert rows(read_keyed(spark, path).select(*want.columns)) == rows(want)
print("same results")
"""


def test_results_survive_lost_tasks(sf_dir):
    root = Path(__file__).resolve().parent.parent
    run = subprocess.run([sys.executable, "-c", SCRIPT, sf_dir], cwd=root, capture_output=True, text=True, timeout=300)
    assert "same results" in run.stdout, run.stderr[-3000:]
