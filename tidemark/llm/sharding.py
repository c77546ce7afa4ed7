"""Random order and shards for documents.

Method: two-pass external shuffle. The first pass scatters records by a seeded
hash into buckets that fit a task's memory; the second shuffles each bucket by
Fisher and Yates and gives its records the next places of the whole order.
Record r of that order is record r // shards of shard r % shards, so the shards'
counts are at most one apart.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARDS = 24
SEED = 20_000
BUCKET_BYTES = 16 << 20
Key = tuple[pa.Scalar, ...]


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A permutation of n that seed and bucket decide; numpy swaps from the end as Fisher and Yates do."""
    return np.random.Generator(np.random.PCG64([seed, bucket])).permutation(n)


def sharded(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`docs` with two more columns: shard (0 to shards - 1) and slot (from 0 without gaps).

    The order depends on the rows, the seed and the number of buckets (by bytes of
    text), not on how the rows lie in files. Null ids and texts are values like
    others; rows that are equal in id and text may swap places. Columns of the
    names shard and slot are replaced. An empty frame gives an empty one.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    docs = docs.drop("shard", "slot")
    content = F.col(text).cast("string")
    total = docs.agg(F.sum(F.octet_length(content))).first()[0] or 0
    n = total // BUCKET_BYTES + 1
    spread = F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id), F.crc32(content)), F.lit(n))
    own, tie = (f"_{name}_{uuid.uuid4().hex}" for name in ("bucket", "tie"))  # no column of the input's
    scattered = docs.select("*", spread.alias(own), F.xxhash64(doc_id, content).alias(tie))
    counts = {r[own]: r["count"] for r in scattered.groupBy(own).count().collect()}  # one row per bucket
    sizes = np.array([counts.get(b, 0) for b in range(n)], np.int64)
    before = docs.sparkSession.sparkContext.broadcast(np.cumsum(sizes) - sizes)
    names = docs.columns

    def shuffle(key: Key, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        table = table.sort_by(tie).select(names)
        rank = before.value[bucket] + np.arange(table.num_rows)
        table = table.take(pa.array(fisher_yates(table.num_rows, seed, bucket)))
        return table.append_column("shard", pa.array((rank % shards).astype(np.int32))).append_column(
            "slot", pa.array(rank // shards)
        )

    schema = T.StructType([*docs.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    return scattered.groupBy(own).applyInArrow(shuffle, schema)


def write_shards(shuffled: DataFrame, path: str) -> None:
    """One folder per shard, its records in order of slot."""
    by_shard = shuffled.repartition("shard").sortWithinPartitions("shard", "slot")
    by_shard.write.partitionBy("shard").parquet(path)
