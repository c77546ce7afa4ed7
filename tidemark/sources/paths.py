"""The few file-system calls Spark's readers and writers do not cover."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """Hadoop file system of `path`, and the path as it knows it."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, file = file_system(spark, path)
    return fs.exists(file)


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether any data file lies below `path`; stops at the first."""
    fs, folder = file_system(spark, path)
    if not fs.exists(folder):
        return False
    found = fs.listFiles(folder, True)
    while found.hasNext():
        if not found.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none where there is no folder."""
    fs, folder = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, file = file_system(spark, path)
    stream = fs.open(file)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, folder = file_system(spark, path)
    return fs.getContentSummary(folder).getLength()


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Delete a folder when the session's JVM ends."""
    fs, folder = file_system(spark, path)
    fs.deleteOnExit(folder)
