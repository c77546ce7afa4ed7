"""Run every query on Spark and its SQL on DuckDB, and compare rows and types.

python -m checks.compare [folder] [name …]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES

# Types that say the same in both engines.
SAME = {"large_string": "string", "int64": "int64"}


def types_of(table) -> dict[str, str]:
    return {f.name: SAME.get(str(f.type), str(f.type)).replace("timestamp[us, tz=UTC]", "ltz") for f in table.schema}


def rows_of(table) -> Counter:
    names = sorted(table.column_names)
    return Counter(zip(*[table.column(n).to_pylist() for n in names]))


def connect(sf_dir: str):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def compare(spark: SparkSession, con, sf_dir: str, name: str, frame: DataFrame | None = None) -> str:
    """Empty text when equal, otherwise what differs; `frame` is the query's result if it is made already."""
    ours = (QUERIES[name](spark, sf_dir) if frame is None else frame).toArrow()
    if name not in ORACLE:
        return "" if ours.num_rows else "no rows"
    theirs = con.sql(ORACLE[name]).to_arrow_table()
    mine, other = types_of(ours), types_of(theirs)
    if mine != other:
        return f"types differ: {sorted(set(mine.items()) ^ set(other.items()))}"
    a, b = rows_of(ours), rows_of(theirs)
    if a != b:
        return f"{ours.num_rows} rows against {theirs.num_rows}: {list((a - b).items())[:2]} {list((b - a).items())[:2]}"
    return "" if ours.num_rows else "no rows"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:  # report every query, also after a failure
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:34s} {time.time() - start:6.2f}s {problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(main())
