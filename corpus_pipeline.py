"""From raw documents to shards of a training mix: stages that each use one operator of tidemark.llm."""

from __future__ import annotations

import sys
import uuid
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.llm import toxicity  # noqa: E402
from tidemark.llm.decontamination import find_leaks  # noqa: E402
from tidemark.llm.jaccard_join import similar_groups  # noqa: E402
from tidemark.llm.mixing import mixed_documents  # noqa: E402
from tidemark.llm.sharding import sharded  # noqa: E402
from tidemark.llm.shared import read_table, written  # noqa: E402
from tidemark.operators.joins import join_grouped  # noqa: E402

WEIGHTS = [5, 2, 1]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; null and empty texts stay."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    # Columns go by number meanwhile, so that none is taken for one of the model's.
    names = [f"_column_{i}" for i in range(len(docs.columns))]
    rows = toxicity.scored(docs.toDF(*names), model, text=names[docs.columns.index("text")])
    return rows.filter(F.col("score") < toxicity.THRESHOLD).select(*names).toDF(*docs.columns)


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a key, and its name: a hash of id and text, so rows that differ in either are told apart."""
    name = f"_key_{uuid.uuid4().hex}"
    return docs.withColumn(name, F.xxhash64("doc_id", "text")), name


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id, null last; of equal ids and texts one row.

    Texts without words are nobody's copies: all of those with a null id stay.
    """
    rows, key = keyed(docs)
    groups = similar_groups(rows, doc_id=key).select(F.col("doc_id").alias(key), "n_shingles", "component_id").distinct()
    ids = rows.select(key, "doc_id").distinct()
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", key, "n_shingles")).alias("best")
    first = groups.join(ids, key).groupBy("component_id").agg(best).select(f"best.{key}", "best.n_shingles")
    own = F.col("doc_id").isNull() & (F.col("r.n_shingles") == 0)
    kept = join_grouped(rows, first, [key]).select("l.*", own.alias(f"{key}_own"))
    order = Window.partitionBy(key, "doc_id", "text").orderBy(*docs.columns)
    numbered = kept.withColumn(f"{key}_row", F.row_number().over(order))
    return numbered.filter((F.col(f"{key}_row") == 1) | F.col(f"{key}_own")).select(*docs.columns)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, whatever other documents of their id hold."""
    rows, key = keyed(docs)
    held = find_leaks(rows, read_table(spark, sf_dir, "benchmark"), doc_id=key)
    held = held.select(F.col("doc_id").alias(key)).distinct()
    return join_grouped(rows, held, [key], "left_anti").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixed_documents(docs, WEIGHTS)


def in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in random order, by shard and slot."""
    return sharded(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("jaccard_join", without_near_copies),
    ("decontamination", without_leaks),
    ("mixing", mixed),
    ("sharding", in_shards),
]

# The toxicity model is trained, which SQL does not express; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared folder and read by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
