"""What operators share: the cluster's folder for intermediate data, table access, document order."""

from __future__ import annotations

import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """This session's folder in the one the cluster names for intermediate data; it goes when the session's JVM ends.

    Only where the cluster names none, as in tests, a new one is made.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        base = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(base or tempfile.mkdtemp(prefix="checkpoints-"))
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    folder = f"{base.rstrip('/')}/documents-{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """The frame's rows, written to the shared folder and read from there.

    Later reads do not depend on executors that may be lost, and plans start anew.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shipped(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast a value of bounded size, its classes included; tasks call what this returns to get it."""
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(packed.value)


def held_out(doc_id: str = "doc_id"):
    """Rows whose label must not be learned: crc32 of the id as text leaves 2 modulo 4."""
    text = F.col(doc_id).cast("string")
    return F.coalesce(F.crc32(text) % 4 == 2, F.lit(False))


def unit_hash(*columns, seed: int):
    """A number from 0 up to 1 that depends on the columns and the seed alone."""
    bits = F.xxhash64(F.lit(seed), *columns)
    return F.pmod(bits, F.lit(1 << 52)).cast("double") / float(1 << 52)


def parts(texts: list[bytes], size: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` bytes each, one text at least."""
    a, held = 0, 0
    for b, text in enumerate(texts, 1):
        held += len(text)
        if held >= size or b == len(texts):
            yield a, b
            a, held = b, 0


def examples(
    docs: DataFrame, marked: DataFrame, kind: str, kinds: int, most: Column, most_bytes: int, seed: int
) -> tuple[list[Row], dict[Any, int]]:
    """Texts to learn from: rows (doc_id, text, `kind`), and how many texts there are of each kind.

    `marked` has a row (doc_id, digest, size, `kind`) for each text that may be
    chosen, as `text_facts` gives them. Of each of the `kinds` most frequent kinds
    come at most `most` texts and `most_bytes` bytes, those whose id and text hash
    lowest; texts of over a sixteenth of `most_bytes` are not learned from. Equal
    rows are one text, so neither repeated ids nor repeated rows make it more.
    """
    small = written(marked.filter(F.col("size") <= most_bytes // 16), "marked")
    counts = small.groupBy(kind).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), kind).limit(kinds)
    # About twice as many by their hash alone, so that no kind's rows meet in one task.
    low = small.join(F.broadcast(counts), kind).withColumn("u", unit_hash("doc_id", "digest", seed=seed))
    low = low.filter(F.col("u") * F.col("n") <= 2 * most + 100)
    order = Window.partitionBy(kind).orderBy("u", "doc_id", "digest")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    low = low.withColumn("r", F.row_number().over(order)).withColumn("total", F.sum("size").over(so_far))
    chosen = low.filter((F.col("r") <= most) & (F.col("total") <= most_bytes)).select("doc_id", "digest", kind)
    texts = text_facts(docs).join(F.broadcast(chosen), ["doc_id", "digest"])  # at most kinds * most rows
    rows = texts.groupBy("doc_id", "digest", kind).agg(F.min("text").alias("text")).drop("digest").collect()
    found = {r[kind]: r["n"] for r in counts.collect()}
    return sorted(rows, key=lambda r: (r["doc_id"], r["text"] or "", r[kind])), found


def text_facts(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, text, digest, size) and the columns `more` of all rows that are not held out; a row without id is none to learn from."""
    rows = docs.filter(~held_out() & F.col("doc_id").isNotNull())
    rows = rows.select("doc_id", F.col("text").cast("string").alias("text"), *more)
    return rows.withColumns({"digest": F.xxhash64("text"), "size": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")})
