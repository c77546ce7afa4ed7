"""Times the registered queries; prints one JSON line.

BENCH_SF_DIR    folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS      threads (default 8)
BENCH_QUERIES   names with commas between them (default: all)
BENCH_RUNS      timed rounds over all queries after one to warm up (default 3; the median counts)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from checks.queries import QUERIES  # noqa: E402
from tidemark.session import get_session  # noqa: E402


def timed(spark: SparkSession, sf_dir: str, name: str) -> float:
    """Seconds to build the query and run it to the end, results thrown away."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    conf = {
        "spark.master": f"local[{cpus}]",
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidemark-bench-"),
    }
    spark = get_session("bench", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    rounds = [{name: timed(spark, sf_dir, name) for name in names} for _ in range(1 + runs)][1:]
    times = {name: round(statistics.median(r[name] for r in rounds), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
