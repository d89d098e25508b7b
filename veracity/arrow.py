"""Steps over Arrow batches in Python workers: what the operators that use them share."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Most bytes of an Arrow batch that a Python worker is sent (a longer row goes alone). Spark's own bound of 64 MB is
#: held on both sides of the pipe by each task, at times twice, beside the heap.
BATCH_BYTES = 4 << 20


_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def worker_path(spark: SparkSession) -> None:
    """Let Python workers import this package also when the driver was started in another folder
    (a cluster that ships the package itself already has it on its path)."""
    env = spark.sparkContext.environment
    path = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in path:
        env["PYTHONPATH"] = os.pathsep.join([p for p in path if p] + [_ROOT])


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of the session's Arrow batches; a smaller bound that it already has stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).removesuffix("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def map_arrow(df: DataFrame, fn: Callable, schema: StructType | str, keeps: bool = False) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path. ``keeps``: ``fn`` uses what ``REMEMBERED`` holds;
    before any other function it is dropped, and a task leaves no free memory in its worker."""
    worker_path(df.sparkSession)
    small_batches(df.sparkSession)

    def run(batches):
        begin_task(keeps)
        yield from fn(batches)
        release_memory()

    return df.mapInArrow(run, schema)


#: What a worker keeps from one task to the next.
REMEMBERED: dict = {}


def begin_task(keeps: bool) -> None:
    if not keeps:
        REMEMBERED.clear()
    release_memory()


def release_memory() -> None:
    """Give a reused worker's free memory, left by the steps before, back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):                # another C library than glibc
        pass


#: Classes of characters in Java's patterns, without their brackets.
JAVA_WORD, JAVA_UPPER = r"\p{L}\p{N}_", r"\p{IsUppercase}"
_CHARS: dict[str, bytes] = {}


def java_chars(spark: SparkSession, chars: str) -> bytes:
    """A bit for each character: whether the class ``chars`` of a Java pattern takes it. Java itself is asked, once a
    process, since it follows another version of Unicode than Python."""
    if chars not in _CHARS:
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        left = spark._jvm.java.util.regex.Pattern.compile(f"[^{chars}]+").matcher(every).replaceAll("")
        bits = np.zeros(0x110000, bool)
        bits[np.frombuffer(left.encode("utf-32-le"), np.uint32)] = True
        _CHARS[chars] = np.packbits(bits).tobytes()
    return _CHARS[chars]
