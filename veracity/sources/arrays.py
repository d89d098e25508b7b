"""JSON arrays read by byte ranges: a file of one array is parsed by as many tasks as it has splits.

A record's end can only be told by a reader that knows whether it stands inside a string and how deep
inside objects. Both are found in two passes over the same splits:

1. Each split is read as segments that end with ``}`` and reports three numbers: its quotes and, for
   either state at its start (outside or inside a string), how far it goes down or up in depth.
   Running sums over the splits of a file, one small row each, give every split's true start.
2. Each split cuts its own records. What it has of a record that begins or ends in another split is a
   fragment; the fragments of a file, two a split at most, are put together by their order.

A ``}`` inside a string ends a segment, not a record, and an escaped quote is no quote. A segment never
ends within an escape, since ``\\}`` is none in JSON.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.session import ensure_checkpoint_dir

SPLIT_BYTES = 128 << 20
PIECES = "file long, at long, part int, body binary"
_ESCAPE = re.compile(rb"\\.", re.DOTALL)
_STRING_OR_OPEN = re.compile(rb'"(?:[^"\\]|\\.)*"|\{', re.DOTALL)


def fixed_splits(spark: SparkSession, split_bytes: int) -> SparkSession:
    """A session of the same context whose file splits depend on ``split_bytes`` alone, not on the cores
    at hand, with one split a task: two passes then see the same splits, whatever executors are lost."""
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", str(split_bytes))
    return own


def _segment(seg: bytes, inside: bool) -> tuple[int, bool]:
    """Objects opened by a segment, and whether it ends inside a string."""
    if b"\\" in seg:
        seg = _ESCAPE.sub(b"", seg)
    if b'"' not in seg:
        return (0 if inside else seg.count(b"{")), inside
    parts = seg.split(b'"')
    opened = sum(p.count(b"{") for p in parts[int(inside)::2])
    return opened, inside ^ (len(parts) % 2 == 0)


def _split_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, states = None, [[0, False], [0, True]]                          # depth, inside: from either start
    for b in batches:
        for seg in b.column(2):
            for s in states:
                opened, s[1] = _segment(seg.as_py(), s[1])
                s[0] += opened - (not s[1])
        if b.num_rows:
            key = (b.column(0)[0].as_py(), b.column(1)[0].as_py())
    if key is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([states[0][1]]),
             pa.array([states[0][0]], pa.int64()), pa.array([states[1][0]], pa.int64())],
            ["file", "at", "flips", "from_out", "from_in"])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records (``part`` 0), and fragments: 1 goes on from an earlier split, 2 begins here and goes
    on in a later one."""
    depth, inside, cur, part, key = None, False, [], 0, None
    for b in batches:
        out = []
        for k, seg in enumerate(b.column(2)):
            seg = seg.as_py()
            if depth is None:
                key = (b.column(0)[k].as_py(), b.column(1)[k].as_py())
                depth, inside = b.column(3)[k].as_py(), b.column(4)[k].as_py()
                part = 1 if depth else 0
            if not depth:                                                # between records, never inside a string
                first = next((m.start() for m in _STRING_OR_OPEN.finditer(seg) if m.group() == b"{"), None)
                if first is None:
                    continue
                seg, part = seg[first:], 0
            opened, inside = _segment(seg, inside)
            cur.append(seg)
            depth += opened - (not inside)
            if not depth:
                out.append((part, b"}".join(cur) + b"}"))
                cur = []
        yield _pieces(key, out)
    if cur:
        yield _pieces(key, [(1 if part else 2, b"}".join(cur) + b"}")])


def _pieces(key, rows) -> pa.RecordBatch:
    n = len(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array([key and key[0]] * n, pa.int64()), pa.array([key and key[1]] * n, pa.int64()),
         pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
        ["file", "at", "part", "body"])


def array_records(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row ``json`` for each object of the arrays under ``path``, as it stands in the file.

    The pieces are written once, as a step in the checkpoint folder; from there they can be read in any
    session and by any number of tasks. What is broadcast is one row of 40 bytes a split. A record that
    its file never ends is a row too; elements that are no objects are left out.
    """
    own = fixed_splits(spark, split_bytes)
    segments = own.read.option("lineSep", "}").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.col("value").cast("binary").alias("seg"))
    states = segments.mapInArrow(_split_states, "file long, at long, flips boolean, from_out long, from_in long")
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    states = states.withColumn("inside", F.coalesce(F.sum(F.col("flips").cast("int")).over(before), F.lit(0)) % 2 == 1)
    went = F.when(F.col("inside"), F.col("from_in")).otherwise(F.col("from_out"))
    states = states.withColumn("went", went).select(
        "file", "at", F.coalesce(F.sum("went").over(before), F.lit(0)).alias("depth"), "inside")
    step = f"{ensure_checkpoint_dir(spark)}/array-{uuid.uuid4().hex}"
    (segments.join(F.broadcast(states), ["file", "at"]).mapInArrow(_records, PIECES)
     .write.partitionBy("part").parquet(step))
    pieces = spark.read.schema(PIECES).parquet(step)
    whole = pieces.where("part = 0").select("body")
    order = Window.partitionBy("file").orderBy("at", "part")
    parts = pieces.where("part > 0").withColumn("record", F.count_if(F.col("part") == 2).over(order))
    joined = (parts.groupBy("file", "record")
              .agg(F.sort_array(F.collect_list(F.struct("at", "part", "body"))).alias("p"))
              .select(F.expr("aggregate(p, cast('' as binary), (s, x) -> s || x.body)").alias("body")))
    return whole.unionByName(joined).select(F.col("body").cast("string").alias("json"))


def read_array(spark: SparkSession, path: str, schema: T.StructType, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The objects of the arrays under ``path`` in a declared schema; one that cannot be parsed is a row
    of nulls."""
    return array_records(spark, path, split_bytes).select(F.from_json("json", schema).alias("r")).select("r.*")
