"""Hard negatives by Kronecker-packed products.

Vectors are whole numbers. For each anchor, the nearest other rows of its label are positives; for each
positive, the nearest rows of another label are its hard negatives, within a margin below the positive.

Scores are exact inner products. Components are made non-negative by a bias, and the same component of
several rows goes into separated fields of one wide integer: ``w = sum((c_g + bias) << (bits * g))``.
One multiplication of ``w`` by an anchor's (biased) component multiplies all fields, and the sum over the
components holds every row's product sum in its field, since ``bits`` is taken from the largest sum that
a field can hold. Unpacking takes the biases' share away. Fields share 64-bit words when at least one
fits, else Python's integers, which have no limit.

How it runs: anchors are met in blocks of ``block_bytes`` (which bounds what the driver and a task hold at
once, whatever their number), each against all rows, read where they lie: a first pass over the rows of
the anchors' labels for the positives, and a second over all rows for the negatives, since only then the
margins are known. A task keeps the best rows of each anchor as it goes and returns no more than these;
the tasks' best are ranked by a window, whose groups grow with the number of tasks only. No row is paired
with another in a join. Blocks are written as they end.

Defined cases: rows with a null label, vector or id, or with any null or non-finite component, take no
part; anchors and positives are told apart by id, so rows that repeat are listed once each as negatives or
positives and once as an anchor; vectors of different lengths meet as if the shorter one ended in zeros;
an anchor without a positive and a positive without a negative give no row; equal scores go by id; an empty
table gives an empty result. Scores must fit a long. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracity.llm.common import cut_lineage, map_arrow

#: Rows that a task packs and scores at once against ``ANCHOR_STEP`` anchors.
ROW_STEP, ANCHOR_STEP = 2048, 256
_NONE = np.iinfo(np.int64).min


def packed_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All inner products (anchors x rows) of whole-number vectors, exactly."""
    dims = anchors.shape[1]
    if not dims or not len(anchors) or not len(rows):
        return np.zeros((len(anchors), len(rows)), np.int64)
    bias_a, bias_r = -min(0, int(anchors.min())), -min(0, int(rows.min()))
    most = dims * (int(anchors.max()) + bias_a) * (int(rows.max()) + bias_r)
    bits = max(1, most.bit_length())
    kind = np.uint64 if bits <= 64 else object
    fields = 64 // bits if bits <= 64 else 8
    words = -(-len(rows) // fields)
    biased_r = np.zeros((words * fields, dims), kind)
    biased_r[:len(rows)] = (rows.astype(object) + bias_r if kind is object else (rows + bias_r).astype(kind))
    biased_a = anchors.astype(object) + bias_a if kind is object else (anchors + bias_a).astype(kind)
    wide = np.zeros((dims, words), kind)            # field g of word w is row w * fields + g
    for g in range(fields):
        shift = bits * g if kind is object else np.uint64(bits * g)
        wide |= biased_r[g::fields].T << shift
    # One product per anchor component for all fields of a word (a 64-bit sum by einsum, without copies).
    sums = (biased_a[:, :, None] * wide[None]).sum(1) if kind is object else np.einsum("ad,dw->aw", biased_a, wide)
    out = np.empty((len(anchors), words * fields), kind)
    mask = (1 << bits) - 1
    for g in range(fields):
        shift = bits * g if kind is object else np.uint64(bits * g)
        out[:, g::fields] = (sums >> shift) & (mask if kind is object else np.uint64(mask))
    out = out[:, :len(rows)]
    # sum((a + A)(c + B)) = sum(ac) + A sum(c) + B sum(a) + dAB
    exact = object if kind is object or most.bit_length() > 61 else np.int64
    less = (bias_a * rows.astype(exact).sum(1))[None, :] + (bias_r * anchors.astype(exact).sum(1))[:, None]
    return (out.astype(exact) - less - dims * bias_a * bias_r).astype(np.int64)


class _Best:
    """The ``top`` best (score, id) of each of ``n`` slots, filled step by step."""

    def __init__(self, n: int, top: int):
        self.score = np.full((n, top), _NONE, np.int64)
        self.id = np.full((n, top), np.iinfo(np.int64).max, np.int64)
        self.top = top

    def least(self, slots: np.ndarray) -> np.ndarray:
        return self.score[slots, -1]

    def add(self, slots: np.ndarray, score: np.ndarray, ids: np.ndarray, ok: np.ndarray) -> None:
        """``score[i, j]`` of the row ``ids[j]`` for the slot ``slots[i]``, where ``ok``."""
        ok = ok & (score >= self.least(slots)[:, None])
        many = ok.sum(1) > 4 * self.top
        if many.any():                              # leave those below the last place of this step's own
            part = np.where(ok[many], score[many], _NONE)
            last = np.partition(part, part.shape[1] - self.top, 1)[:, part.shape[1] - self.top]
            ok[many] &= score[many] >= last[:, None]
        i, j = np.nonzero(ok)
        if not len(i):
            return
        touched, own = np.unique(i, return_inverse=True)
        at = slots[touched]
        every = np.concatenate([np.repeat(np.arange(len(touched)), self.top), own])
        s = np.concatenate([self.score[at].ravel(), score[i, j]])
        v = np.concatenate([self.id[at].ravel(), ids[j]])
        order = np.lexsort((v, -(s + 1), every))    # -(s + 1): no overflow at the least long
        every, s, v = every[order], s[order], v[order]
        rank = np.arange(len(every)) - np.searchsorted(every, every)
        keep = rank < self.top
        self.score[at] = s[keep].reshape(len(touched), self.top)
        self.id[at] = v[keep].reshape(len(touched), self.top)


def _matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """A list column of whole numbers as a matrix; shorter rows end in zeros."""
    offsets = np.asarray(column.offsets)
    size = np.diff(offsets)
    flat = np.asarray(column.values)[offsets[0]:offsets[-1]].astype(np.int64)
    width = int(size.max(initial=0)) if width is None else width
    out = np.zeros((len(size), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], size)
    inside = at < width
    out[row[inside], at[inside]] = flat[inside]
    return out


def _steps(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, matrix) of some rows at a time, sorted by label."""
    for b in batches:
        for lo in range(0, b.num_rows, ROW_STEP):
            part = b.slice(lo, ROW_STEP)
            ids, labels = np.asarray(part.column(0)), np.asarray(part.column(1))
            order = np.argsort(labels, kind="stable")
            yield ids[order], labels[order], _matrix(part.column(2), width)[order]


def _best_rows(slots: np.ndarray, best: _Best) -> pa.RecordBatch:
    i, j = np.nonzero(best.score != _NONE)
    return pa.RecordBatch.from_arrays(
        [pa.array(slots[i], pa.int64()), pa.array(best.score[i, j], pa.int64()), pa.array(best.id[i, j], pa.int64())],
        ["slot", "score", "other"])


def _ranked(best: DataFrame, top: int) -> DataFrame:
    """``rank`` from 1 of each slot's best rows over all tasks."""
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "other")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def whole_vectors(rows: DataFrame, id_col: str, label: Column, vec_col: str, scale: float) -> DataFrame:
    """``(id, label, vec)`` of the rows that take part, components as ``floor(scale * x)``."""
    x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & sound)
            .select("id", "label", F.transform("x", lambda v: F.floor(v * scale).cast("long")).alias("vec")))


def mine_hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5,
                        margin_pct: int = 80, block_bytes: int = 16 << 20) -> DataFrame:
    """``vectors(id, label, vec)`` and ``anchors`` of the same columns -> one row per anchor, positive and
    negative: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``, where
    ``margin_pct * positive_score <= 100 * negative_score <= 100 * positive_score``."""
    spark = vectors.sparkSession
    anchors = anchors.select("id", "label", "vec").distinct()
    size = anchors.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("width")).first()
    blocks = max(1, -(-int(size["n"]) * (int(size["width"]) + 8 * positives) * 8 // block_bytes))
    anchors = cut_lineage(anchors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))))
    out = None
    for k in range(blocks):
        block = anchors.where(F.col("block") == k).select("id", "label", "vec").toArrow().combine_chunks()
        if not block.num_rows:
            continue
        found = cut_lineage(_mine_block(vectors, block, positives, negatives, margin_pct))
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    return out


def _mine_block(vectors: DataFrame, block: pa.Table, positives: int, negatives: int, margin_pct: int) -> DataFrame:
    spark = vectors.sparkSession
    order = np.argsort(np.asarray(block["label"]), kind="stable")
    a_id, a_label = np.asarray(block["id"])[order], np.asarray(block["label"])[order]
    vec = block["vec"].combine_chunks()
    a_vec = _matrix(vec.chunk(0) if isinstance(vec, pa.ChunkedArray) else vec)[order]
    width, n = a_vec.shape[1], len(a_id)

    def nearest(batches):
        best = _Best(n, positives)
        for ids, labels, m in _steps(batches, width):
            for label in np.unique(labels):
                lo, hi = np.searchsorted(a_label, label), np.searchsorted(a_label, label, side="right")
                rows = slice(np.searchsorted(labels, label), np.searchsorted(labels, label, side="right"))
                for at in range(lo, hi, ANCHOR_STEP):
                    some = np.arange(at, min(hi, at + ANCHOR_STEP))
                    best.add(some, packed_scores(a_vec[some], m[rows]), ids[rows],
                             a_id[some][:, None] != ids[rows][None, :])
        yield _best_rows(np.arange(n), best)

    schema = "slot long, score long, other long"
    found = _ranked(map_arrow(vectors, nearest, schema), positives).toArrow()
    # Slot p of the second pass: one positive of one anchor; its anchors' slots are consecutive.
    p_order = np.lexsort((np.asarray(found["rank"]), np.asarray(found["slot"])))
    p_anchor = np.asarray(found["slot"])[p_order]
    p_score, p_id = np.asarray(found["score"])[p_order], np.asarray(found["other"])[p_order]
    p_least = np.array([-((-margin_pct * int(s)) // 100) for s in p_score], np.int64)
    first = np.searchsorted(p_anchor, np.arange(n + 1))

    def hardest(batches):
        best = _Best(len(p_id), negatives)
        for ids, labels, m in _steps(batches, width):
            for at in range(0, n, ANCHOR_STEP):
                end = min(n, at + ANCHOR_STEP)
                if first[at] == first[end]:
                    continue
                score = packed_scores(a_vec[at:end], m)
                other = a_label[at:end, None] != labels[None, :]
                for k in range(int(np.diff(first[at:end + 1]).max())):
                    slots = first[at:end] + k
                    has = np.flatnonzero(slots < first[at + 1:end + 1])
                    slots, s = slots[has], score[has]
                    ok = other[has] & (s <= p_score[slots][:, None]) & (s >= p_least[slots][:, None])
                    best.add(slots, s, ids, ok)
        yield _best_rows(np.arange(len(p_id)), best)

    slots = spark.createDataFrame(pa.table({
        "slot": np.arange(len(p_id)), "anchor_id": a_id[p_anchor], "positive_id": p_id, "positive_score": p_score}))
    hard = _ranked(map_arrow(vectors, hardest, schema), negatives)
    return hard.join(slots, "slot").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
