"""Sum-of-squares online packing of documents into token windows.

A window has ``capacity`` tokens. ``N[h]`` is the number of open windows filled to level ``h``.
A document's ids (with the end id) first fill whole windows; the rest goes to the fill level that
makes the sum of the squared ``N[h]`` smallest: an open window of some level, or a new one. The
level array is all the state that the choice needs. Documents may be cut, so when a task ends, or
holds more open windows than its bound, the emptiest windows are poured into the fullest ones:
each task leaves one window that is not full at most.

Tasks pack their own rows in the order in which they read them, so nothing is shuffled, memory is
bounded by the open windows, and a repeated task gives the same windows again.

Defined cases: null counts as an empty text, which is the end id alone; rows that repeat are
packed each; an empty table gives no pieces. Only the id and the text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from veracity.llm.common import map_arrow
from veracity.llm.tokens import MEMO_BYTES, ChunkIds, chunk_coder


class LevelPacker:
    """The windows of one task. ``done`` holds full windows: lists of (doc, start, ids, doc_tokens)."""

    def __init__(self, capacity: int, max_open: int = 2048):
        self.capacity, self.max_open, self.n_open = capacity, max_open, 0
        self.count = np.zeros(capacity + 1, np.int64)          # N[h]; level 0 and the full one stay 0
        self.open: dict[int, list[list]] = {}
        self.done: list[list] = []

    def _put(self, level: int, window: list) -> None:
        if level == self.capacity:
            self.done.append(window)
        else:
            self.open.setdefault(level, []).append(window)
            self.count[level] += 1
            self.n_open += 1

    def _take(self, level: int) -> list:
        self.count[level] -= 1
        self.n_open -= 1
        return self.open[level].pop()

    def level_for(self, size: int) -> int:
        """The level to place ``size`` tokens in (0: a new window); of equal ones the fullest."""
        c, n = self.capacity, self.count
        low, high = n[1:c - size + 1], n[1 + size:c + 1]
        change = 2 * (high - low) + 2
        if len(change):
            change[-1] -= 1                                    # a window that gets full leaves the sum
            change[low == 0] = np.iinfo(np.int64).max
            k = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[k] <= 2 * n[size] + 1:
                return k + 1
        return 0

    def add(self, doc, ids: np.ndarray) -> None:
        total, lo = len(ids), 0
        while total - lo >= self.capacity:
            self.done.append([(doc, lo, ids[lo:lo + self.capacity], total)])
            lo += self.capacity
        if lo < total:
            size = total - lo
            level = self.level_for(size)
            window = self._take(level) if level else []
            window.append((doc, lo, ids[lo:], total))
            self._put(level + size, window)
            if self.n_open > self.max_open:
                self.pour(self.max_open // 2)

    def pour(self, leave: int) -> None:
        """Fill the fullest windows from the emptiest ones until ``leave`` are open."""
        while self.n_open > leave:
            levels = np.flatnonzero(self.count)
            top, low = int(levels[-1]), int(levels[0])
            into, fill = self._take(top), top
            source, left = self._take(low), low
            while fill < self.capacity and left:
                doc, start, ids, total = source.pop()
                n = min(len(ids), self.capacity - fill)
                if n < len(ids):
                    source.append((doc, start, ids[:len(ids) - n], total))
                into.append((doc, start + len(ids) - n, ids[len(ids) - n:], total))
                fill += n
                left -= n
            self._put(fill, into)
            if left:
                self._put(left, source)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = 4096, end_id: int = 2, max_open: int = 2048,
                   memo_bytes: int = MEMO_BYTES) -> DataFrame:
    """One row per piece: ``id_col, start, length, doc_tokens, sequence_id, offset`` and ``ids``
    (little-endian 32-bit, in a binary column). Windows that are not full are padded by the reader.
    A result column that the id column's name would clash with gets ``piece_`` before its name. A worker
    remembers chunks within ``memo_bytes``: fewer cost time, and change no id."""
    rows = docs.select(id_col, text_col)
    *names, ids_col = [f"piece_{c}" if c == id_col.lower() else c
                       for c in ("start", "length", "doc_tokens", "sequence_id", "offset", "ids")]
    schema = StructType([rows.schema[0], *(StructField(c, LongType()) for c in names), StructField(ids_col, BinaryType())])

    def run(batches):
        coder, packer = chunk_coder(ChunkIds, tokenizer_path, memo_bytes), LevelPacker(capacity, max_open)
        end, number = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId() << 33

        def drain(id_type):
            nonlocal number
            cols: list[list] = [[] for _ in range(7)]
            for window in packer.done:
                at = 0
                for doc, start, ids, total in window:
                    for c, v in zip(cols, (doc, start, len(ids), total, number, at, ids.tobytes())):
                        c.append(v)
                    at += len(ids)
                number += 1
            packer.done = []
            types = [id_type, *[pa.int64()] * 5, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [id_col, *names, ids_col])

        id_type = None
        for b in batches:
            id_type, size = b.schema.field(0).type, 0
            for doc, v in zip(b.column(0), b.column(1)):
                ids = np.frombuffer(coder.of(v.as_py() or "") + end, "<u4")
                packer.add(doc.as_py(), ids)
                size += len(ids)
                if size > 1 << 19:
                    yield drain(id_type)
                    size = 0
        packer.pour(1)
        for level in np.flatnonzero(packer.count):
            packer.done.extend(packer.open[int(level)])
        if id_type is not None:
            yield drain(id_type)

    return map_arrow(rows, run, schema, keeps=True)
