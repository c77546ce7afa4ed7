"""Bloom filters of bounded size, built by Spark from 64-bit hashes and looked up inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sixteen bits per hash; 16 MB to broadcast at most. Beyond that more hashes pass.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 27
CHUNK = 1 << 16  # bits that one group of the build holds
SECOND = 36  # bits by which a hash is shifted for its second place


def build(hashes: DataFrame, column: str, items: int) -> np.ndarray:
    """The filter of a column of well spread 64-bit hashes, `items` of them; null hashes are left out."""
    size = min(max(1 << (items * BITS_EACH).bit_length(), LEAST_BITS), MOST_BITS)
    h = F.col(column)
    places = F.array(h.bitwiseAND(F.lit(size - 1)), F.shiftrightunsigned(h, SECOND).bitwiseAND(F.lit(size - 1)))
    rows = hashes.filter(h.isNotNull()).select(F.explode(places).alias("place"))
    rows = rows.select((F.col("place") / CHUNK).cast("int").alias("chunk"), (F.col("place") % CHUNK).alias("bit"))

    def chunk_of(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        held = np.zeros(CHUNK, np.uint8)
        held[table["bit"].to_numpy()] = 1
        return pa.table(
            {"chunk": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(held).tobytes()])}
        )

    bitmap = np.zeros(size // 8, np.uint8)
    for row in rows.groupBy("chunk").applyInArrow(chunk_of, "chunk int, bits binary").collect():  # MOST_BITS at most
        at = row["chunk"] * (CHUNK // 8)
        bitmap[at : at + CHUNK // 8] = np.frombuffer(row["bits"], np.uint8)
    return bitmap


def may_hold(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the filter; False is certain."""
    found = np.ones(len(hashes), bool)
    for places in (hashes, hashes >> np.uint64(SECOND)):
        at = (places & np.uint64(len(bitmap) * 8 - 1)).astype(np.int64)
        found &= (bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
    return found
