import pytest
from pyspark.sql import SparkSession

from tidemark import session
from tidemark.functions import sizes


def test_defaults(spark):
    assert session.get_session("other") is not None
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.parquet.int96RebaseModeInRead") == "CORRECTED"


def test_shared_dir_is_new_and_below_the_checkpoint_dir(spark):
    first, second = session.shared_dir(spark, "x"), session.shared_dir(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir")) and first.endswith("/x")


def test_no_folder_of_the_machine():
    class Context:
        master = "local[8]"

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session(), "x")


def test_size_shuffles(spark: SparkSession):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert session.size_shuffles(spark, 100 << 40) == 409_600
        assert sizes.shuffle_parts(spark) == 409_600
        assert session.size_shuffles(spark, 1) == 8
    finally:
        spark.conf.unset(name)
    assert sizes.shuffle_parts(spark) == 8
