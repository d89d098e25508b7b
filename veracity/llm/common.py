"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.arrow import BATCH_BYTES, REMEMBERED, begin_task, map_arrow, release_memory, worker_path  # noqa: F401
from veracity.session import ensure_checkpoint_dir

#: What one vectorised step over texts takes at once (a single longer text is taken alone).
STEP_BYTES = 1 << 18


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write to the cluster's shared checkpoint folder and read back: later steps neither repeat the
    work nor lose it with an executor, and the columnar files are a fraction of checkpointed rows."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/step-{uuid.uuid4().hex}"
    # Mostly hashes, which do not compress; a codec's native buffers would outlive many small tasks.
    df.write.option("compression", "none").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def binary_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of an Arrow string column without copying; null is empty."""
    col = column.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    bufs = col.buffers()
    offsets = np.frombuffer(bufs[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    return data, offsets


def byte_steps(offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges [lo, hi) of at most ``limit`` bytes, or of one row."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def bitmap_of(df: DataFrame, key: str, log2_bits: int) -> np.ndarray:
    """A bitmap of hashed keys: bounded at ``2**log2_bits`` bits whatever the number of keys.

    Built by Spark's bitmap aggregates with map-side combining. It answers "surely absent" or
    "perhaps present", so a caller that filters by it must tolerate extra keys.
    """
    h = F.col(key)
    rows = (df.select(F.shiftrightunsigned(h, 64 - log2_bits).alias("b"))
            .groupBy(F.shiftright("b", 15).alias("block"))
            .agg(F.bitmap_construct_agg(F.col("b").bitwiseAND(F.lit(32767))).alias("bits")).collect())
    out = np.zeros(1 << (log2_bits - 3), np.uint8)
    for r in rows:
        out[r["block"] * 4096:r["block"] * 4096 + 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray, log2_bits: int) -> np.ndarray:
    b = hashes.view(np.uint64) >> np.uint64(64 - log2_bits)
    return (bitmap[(b >> np.uint64(3)).astype(np.int64)] >> (b & np.uint64(7)).astype(np.uint8)) & 1 == 1
