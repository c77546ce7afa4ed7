import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from helpers import plan, rows
from tidemark.sources import catalog, files, jdbc


@pytest.mark.parametrize(
    "fmt,options",
    [
        ("csv", {"header": "true", **files.EXACT_TIMES}),
        ("json", files.EXACT_TIMES),
        ("orc", {}),
        ("parquet", {"compression": "zstd"}),
    ],
)
def test_round_trip(spark, sf_dir, folder, fmt, options):
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    files.write_files(df, fmt, folder, **options)
    back = files.read_files(spark, fmt, folder, df.schema, **options)
    assert back.schema == df.schema and rows(back) == rows(df)


def test_writing_twice_needs_a_mode(spark, folder):
    df = spark.range(3)
    files.write_parquet(df, folder)
    with pytest.raises(AnalysisException):
        files.write_parquet(df, folder)
    files.write_parquet(df, folder, mode="append")
    assert files.read_parquet(spark, folder).count() == 6


def test_csv_defaults(spark, folder):
    files.write_csv(spark.createDataFrame([(1, "a")], "i int, s string"), folder)
    assert files.read_csv(spark, folder).dtypes == [("_c0", "string"), ("_c1", "string")]
    assert files.read_csv(spark, folder, "i int, s string").first().i == 1


def test_scan_reads_and_filters_only_what_is_needed(spark, sf_dir):
    df = files.read_parquet(spark, f"{sf_dir}/lineitem.parquet").filter("l_quantity > 49").select("l_orderkey")
    text = plan(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,49.0)]" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text


def test_partitioned_sink(spark, sf_dir, folder):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    files.write_files(df, "parquet", folder, partition_by="L_RETURNFLAG")
    back = files.read_parquet(spark, folder, df.schema)
    assert rows(back, *df.columns) == rows(df, *df.columns)
    names = [r.path for r in files.file_manifest(spark, folder, "*.parquet").collect()]
    assert len(names) == df.select("l_returnflag").distinct().count()


def test_manifest_does_not_read_contents(spark, sf_dir):
    found = files.file_manifest(spark, sf_dir, "*.parquet")
    assert found.count() == 14 and found.filter("length > 0").count() == 14
    assert "content" not in plan(found).split("ReadSchema:")[1].split("\n")[0]


def test_partitions_are_overwritten_alone(spark, folder):
    def frame(*rows_):
        return spark.createDataFrame(list(rows_), "v int, p string, q int")

    files.write_files(frame((1, "a", 1), (2, "a", 2), (3, "b", 1), (4, None, 1)), "parquet", folder, partition_by=["p", "q"])
    # From the folder itself: one partition runs again, one is new, one of NULL is replaced.
    again = files.read_parquet(spark, folder, "v int, p string, q int").filter("p = 'a' AND q = 1").selectExpr("v * 10 AS v", "p", "q")
    files.write_files(again.union(frame((5, "c", 1), (6, None, 1))), "parquet", folder, "overwrite_partitions", ["p", "q"])
    got = sorted((tuple(r) for r in files.read_parquet(spark, folder, "v int, p string, q int").collect()), key=str)
    assert got == sorted([(10, "a", 1), (2, "a", 2), (3, "b", 1), (5, "c", 1), (6, None, 1)], key=str)
    files.write_files(frame((7, "z", 1)), "parquet", folder, "overwrite", ["p", "q"])
    assert [tuple(r) for r in files.read_parquet(spark, folder).select("v", "p", "q").collect()] == [(7, "z", 1)]
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:  # another writer's setting does not turn a whole overwrite into one of partitions
        files.write_files(frame((8, "y", 1)), "parquet", folder, "overwrite", ["p", "q"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert files.read_parquet(spark, folder).count() == 1
    with pytest.raises(ValueError, match="needs partition_by"):
        files.write_files(frame((1, "a", 1)), "parquet", folder, "overwrite_partitions")


def test_catalog(spark, folder):
    catalog.create_database(spark, "tm_db", folder)
    catalog.create_table(spark, "tm_db.t", "id INT, name STRING, d DATE, p STRING", partition_by="p")
    catalog.create_table(spark, "tm_db.t", "id INT")
    catalog.insert_values(spark, "tm_db.t", ["name", "id", "d", "p"], ["O'Hara; --", 1, dt.date(2024, 1, 2), "x"])
    catalog.insert_values(spark, "tm_db.t", ["id", "name"], [2, None])
    catalog.insert_rows(spark.createDataFrame([("y", 3)], "p string, id int").selectExpr("p", "id", "'n' AS NAME", "NULL AS d"), "tm_db.t")
    got = {r.id: (r.name, r.d, r.p) for r in catalog.select_table(spark, "tm_db.t").collect()}
    assert got == {1: ("O'Hara; --", dt.date(2024, 1, 2), "x"), 2: (None, None, None), 3: ("n", None, "y")}
    assert [tuple(r) for r in catalog.select_table(spark, "tm_db.t", "ID, name", "p = 'x'").collect()] == [(1, "O'Hara; --")]
    catalog.drop_table(spark, "tm_db.t")
    catalog.drop_table(spark, "tm_db.t")
    assert not spark.catalog.tableExists("tm_db.t")


def test_sql_binds_values_and_raises(spark):
    df = spark.createDataFrame([(1, "a'b"), (2, "c")], "i int, s string")
    assert [r.i for r in catalog.run_sql(spark, "SELECT i FROM {t} WHERE s = :s", {"s": "a'b"}, t=df).collect()] == [1]
    with pytest.raises(AnalysisException):
        catalog.run_sql(spark, "SELECT * FROM no_such_table").collect()


def test_jdbc_options():
    """Reading and writing need a database and are not run here."""
    options = jdbc.jdbc_options("jdbc:x:y", "s.t", {"user": "u", "url": "other"})
    assert options == {"user": "u", "url": "jdbc:x:y", "dbtable": "s.t"}


def test_jdbc_split_must_be_given(spark):
    with pytest.raises(TypeError, match="bounds"):
        jdbc.read_jdbc(spark, "jdbc:x:y", "t", split_by="id")


def test_catalog_names_are_quoted(spark, folder):
    from tidemark.sources import catalog

    catalog.create_database(spark, "odd_names", f"{folder}/it's")
    try:
        catalog.create_table(spark, "odd_names.values", "id INT, v STRING")
        catalog.insert_values(spark, "odd_names.values", ["id", "v"], [1, "a"])
        assert [tuple(r) for r in catalog.select_table(spark, "odd_names.`values`").collect()] == [(1, "a")]
    finally:
        catalog.drop_table(spark, "odd_names.values")
        spark.sql("DROP DATABASE odd_names")


def test_schema_of_text_formats_must_be_given(spark, folder):
    from tidemark.plans.daily import Zones, run_table

    spark.range(3).write.json(f"{folder}/landing")
    zones = Zones(f"{folder}/landing", f"{folder}/p", f"{folder}/s", f"{folder}/b", fmt="json")
    with pytest.raises(ValueError, match="schema of json"):
        run_table(spark, zones, None)
