"""Benchmark decontamination: exact containment of item windows in documents.

A window is ``window`` consecutive words of a benchmark item; an item of fewer words, but not
none, is one window. Method: prefix-filtered set join. Each window's word shingles are ordered by
rarity in the documents. A contained window shares all of its shingles, so the necessary prefix is
the rarest one alone: only that token is joined with the documents' shingles. A match gives the
only place where the window can stand; the positional and length bounds drop places outside the
document, and the item-sized window there is verified word by word.

How it runs: the benchmark is the small side. It is taken in blocks of ``block_bytes`` of text, each
collected and broadcast as arrays (some twenty times its bytes at the peak); one pass over the documents counts the block's shingles (map-side,
then one sum per shingle), a second one joins and verifies. Documents are never shuffled or
grouped, so a hot source or a passage that a third of the documents share needs no care. With more
than one block, all but the last write the hits of the documents that have some, which are joined to
the documents by a hash of the whole row before the last one. An item must fit a block's memory.

Defined cases: null or wordless documents have no words and no hits; items without words have no
windows; an item without an id marks words but is not listed; repeated items or ids count once per
id; empty tables give no hits or no rows. Only the named columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from veracity.llm import words as W
from veracity.llm.common import binary_buffers, byte_steps, cut_lineage, map_arrow

_LOG2_SCREEN = 20


class Windows:
    """The distinct windows of a block of items as arrays, and their prefix tokens once rarity is known.

    A window is a place in the block's words: ``begin`` (its first word) and ``length``. Windows of the same
    words are one entry, whose items are ``ids[item_at[k]:item_at[k + 1]]``."""

    def __init__(self, ids: pa.Array, texts: pa.Array, window: int, size: int):
        self.size = size
        data, offsets = binary_buffers(texts)
        low, hashes, starts, ends, first, base = [], [], [], [], [np.zeros(1, np.int64)], 0
        for lo, hi in byte_steps(offsets):
            h, f, a, z = W.words(data, offsets[lo:hi + 1], W.ALNUM)
            n_words = first[-1][-1]
            low.append(W.LOWER[data[offsets[lo]:offsets[hi]]])
            hashes.append(h)
            starts.append(a + base)
            ends.append(z + base)
            first.append(f[1:] + n_words)
            base += len(low[-1])
        flat = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)      # noqa: E731
        self.low, self.h = flat(low, np.uint8).tobytes(), flat(hashes, np.uint64)
        self.start, self.end, first = flat(starts, np.int64), flat(ends, np.int64), flat(first, np.int64)
        n = np.diff(first)
        length = np.minimum(n, window)
        many = np.where(n > 0, n - length + 1, 0)
        begin = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many - first[:-1], many)
        length, item = np.repeat(length, many), np.repeat(np.arange(len(n)), many)
        # Equal windows side by side: by their length and hashes, then told apart by their words' hashes.
        key = np.zeros(len(begin), np.uint64)
        for m in np.unique(length):
            some = length == m
            key[some] = W.shingles(self.h, int(m))[begin[some]]
        order = np.lexsort((begin, key, length))
        begin, length, item, key = begin[order], length[order], item[order], key[order]
        new = np.ones(len(begin), bool)
        for k in np.flatnonzero((length[1:] == length[:-1]) & (key[1:] == key[:-1])) + 1:
            a, z, m = begin[k - 1], begin[k], length[k]
            new[k] = not np.array_equal(self.h[a:a + m], self.h[z:z + m])
        self.begin, self.length = begin[new], length[new]
        entry = np.cumsum(new) - 1
        known = np.asarray(ids.is_valid())[item] if len(item) else np.empty(0, bool)
        self.ids = ids
        self.item = item[known]
        self.item_at = np.searchsorted(entry[known], np.arange(len(self.begin) + 1))

    def items_of(self, k: int) -> set[str]:
        return {self.ids[int(i)].as_py() for i in self.item[self.item_at[k]:self.item_at[k + 1]]}

    def tokens(self) -> dict[int, np.ndarray]:
        """All shingles of the windows, sorted, by their number of words."""
        out: dict[int, list[np.ndarray]] = {}
        for m in np.unique(self.length):
            s = min(self.size, int(m))
            begin, sh = self.begin[self.length == m], W.shingles(self.h, s)
            out.setdefault(s, []).extend(sh[begin + i] for i in range(int(m) - s + 1))
        return {s: np.unique(np.concatenate(x)) for s, x in out.items()}

    def choose(self, tokens: dict[int, np.ndarray], counts: dict[int, np.ndarray]) -> None:
        """Keep for each window its rarest shingle and where it stands in the window; a window of which a
        shingle is in no document is in none."""
        found: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for m in np.unique(self.length):
            s, entry = min(self.size, int(m)), np.flatnonzero(self.length == m)
            sh = W.shingles(self.h, s)
            best_n = best_t = best_at = None
            for i in range(int(m) - s + 1):
                t = sh[self.begin[entry] + i]
                c = counts[s][np.searchsorted(tokens[s], t)]
                if best_n is None:
                    best_n, best_t, best_at = c, t, np.zeros(len(t), np.int64)
                    continue
                less = (c < best_n) | ((c == best_n) & (t < best_t))
                best_n, best_t, best_at = np.where(less, c, best_n), np.where(less, t, best_t), np.where(less, i, best_at)
            has = best_n > 0
            if has.any():
                found.setdefault(s, []).append((best_t[has], entry[has], best_at[has]))
        self.prefix, self.screens = {}, {}
        for s, parts in found.items():
            t, entry, at = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(t, kind="stable")
            self.prefix[s] = (t[order], entry[order], at[order])
            self.screens[s] = _screen(np.unique(t))


def _screen(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A small table that rejects most hashes at once, and the sorted tokens."""
    bits = np.zeros(1 << _LOG2_SCREEN, bool)
    bits[(tokens >> np.uint64(64 - _LOG2_SCREEN)).astype(np.int64)] = True
    return bits, np.sort(tokens)


def _matches(sh: np.ndarray, screen: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Positions of the shingles that are among the screen's tokens."""
    bits, tokens = screen
    at = np.flatnonzero(bits[(sh >> np.uint64(64 - _LOG2_SCREEN)).astype(np.int64)])
    if not len(at):
        return at
    i = np.minimum(np.searchsorted(tokens, sh[at]), len(tokens) - 1)
    return at[tokens[i] == sh[at]]


def _counts(docs: DataFrame, text_col: str, tokens) -> dict[int, np.ndarray]:
    """How often each of the block's shingles occurs in all documents, in the order of the tokens."""
    def run(batches):
        screens = {s: _screen(t) for s, t in tokens.value.items()}
        total = {s: np.zeros(len(t), np.int64) for s, t in tokens.value.items()}
        for b in batches:
            data, offsets = binary_buffers(b.column(0))
            for lo, hi in byte_steps(offsets):
                h, first, _, _ = W.words(data, offsets[lo:hi + 1], W.ALNUM)
                for s, screen in screens.items():
                    sh = W.shingles(h, s)
                    at = _matches(sh, screen)
                    doc = np.searchsorted(first, at, side="right")
                    at = at[at + s <= first[doc]]
                    np.add.at(total[s], np.searchsorted(screen[1], sh[at]), 1)
        for s, n in total.items():
            k = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(k), s, np.int32)), pa.array(tokens.value[s][k].view(np.int64)), pa.array(n[k])],
                ["size", "token", "n"])

    found = (map_arrow(docs.select(text_col), run, "size int, token long, n long")
             .groupBy("size", "token").agg(F.sum("n").alias("n")).toArrow())      # bounded by the block
    size, token = np.asarray(found["size"]), np.asarray(found["token"]).view(np.uint64)
    out = {s: np.zeros(len(t), np.int64) for s, t in tokens.value.items()}
    for s, n in out.items():
        n[np.searchsorted(tokens.value[s], token[size == s])] = np.asarray(found["n"])[size == s]
    return out


def _doc_hits(win: Windows, h, starts, ends, low: bytes, sh_at: dict[int, list[tuple[int, int]]]):
    """Covered [start, end) word ranges, merged, and the items found in one document."""
    spans, items, n = [], set(), len(h)
    for s, found in sh_at.items():
        for p, token in found:
            tokens, entries, offsets = win.prefix[s]
            lo, hi = np.searchsorted(tokens, token), np.searchsorted(tokens, token, side="right")
            for k, off in zip(entries[lo:hi].tolist(), offsets[lo:hi].tolist()):
                a, size, b = p - off, int(win.length[k]), int(win.begin[k])
                if a < 0 or a + size > n or not np.array_equal(h[a:a + size], win.h[b:b + size]):
                    continue
                if all(low[starts[a + i]:ends[a + i]] == win.low[win.start[b + i]:win.end[b + i]] for i in range(size)):
                    spans.append((a, a + size))
                    items |= win.items_of(k)
    return spans, items


def _merge(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", window: int = 13, size: int = 5,
                   keep: tuple[str, ...] = (), block_bytes: int = 2 << 20) -> DataFrame:
    """One row per document: ``id_col``, ``keep`` columns, ``n_words``, ``spans`` (merged word ranges
    inside occurring windows, start and end) and ``items`` (ids as strings, sorted)."""
    spark = docs.sparkSession
    bench = benchmark.select(F.col(item_col).cast("string").alias("item"),
                             F.coalesce(F.col(item_text_col), F.lit("")).alias("t"))
    size_all = bench.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(size_all / block_bytes))
    if blocks > 1:
        bench = cut_lineage(bench.withColumn("block", F.pmod(F.xxhash64("t", "item"), F.lit(blocks))))
    outer = [id_col, *keep]
    names = [f"k{k}" for k in range(len(outer))]                         # kept names may clash with the results'
    span = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(outer, names)], F.col(text_col).alias("__text"), F.lit(None).cast(span).alias("spans"),
                       F.lit(None).cast(ArrayType(StringType())).alias("items"))
    if blocks > 1:                                                       # a row's key: equal rows have equal hits
        every = [*names, "__text"]
        rows = rows.withColumn("key", F.struct(F.xxhash64(*every).alias("a"), F.xxhash64(F.lit(7), *every[::-1]).alias("b")))
    hits = None
    for k in range(blocks):
        part = (bench.where(F.col("block") == k) if blocks > 1 else bench).select("item", "t").toArrow()
        ids, texts = (c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in (part["item"], part["t"]))
        win = Windows(ids, texts, window, size)
        tokens = win.tokens()
        shared = spark.sparkContext.broadcast(tokens)
        win.choose(tokens, _counts(rows, "__text", shared))
        shared.unpersist()
        if k == blocks - 1:
            if hits is not None:
                before = hits.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                                 F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
                rows = rows.drop("spans", "items").join(before, "key", "left").select(*names, "__text", "spans", "items")
            out = _one_block(rows, names, spark.sparkContext.broadcast(win), last=True)
            return out.toDF(*outer, "n_words", "spans", "items")
        some = cut_lineage(_one_block(rows.select("key", "__text", "spans", "items"), ["key"],
                                      spark.sparkContext.broadcast(win), last=False).distinct())
        hits = some if hits is None else hits.unionByName(some)


def _one_block(rows: DataFrame, names: list[str], shared, last: bool) -> DataFrame:
    n0 = len(names)

    def run(batches):
        win = shared.value
        for b in batches:
            data, offsets = binary_buffers(b.column(n0))
            n_words = np.zeros(b.num_rows, np.int64)
            spans = [[(x["start"], x["end"]) for x in v] if v else [] for v in b.column(n0 + 1).to_pylist()]
            items = [set(v or ()) for v in b.column(n0 + 2).to_pylist()]
            for lo, hi in byte_steps(offsets):
                h, first, starts, ends = W.words(data, offsets[lo:hi + 1], W.ALNUM)
                n_words[lo:hi] = np.diff(first)
                found: dict[int, dict[int, list[tuple[int, int]]]] = {}
                for s, screen in win.screens.items():
                    sh = W.shingles(h, s)
                    at = _matches(sh, screen)
                    doc = np.searchsorted(first, at, side="right")
                    for p, d in zip(at.tolist(), doc.tolist()):
                        if p + s <= first[d]:
                            found.setdefault(d - 1, {}).setdefault(s, []).append((p - int(first[d - 1]), sh[p]))
                low = W.LOWER[data[offsets[lo]:offsets[hi]]].tobytes() if found else b""
                for d, sh_at in found.items():
                    a, z = int(first[d]), int(first[d + 1])
                    more, which = _doc_hits(win, h[a:z], starts[a:z], ends[a:z], low, sh_at)
                    spans[lo + d] += more
                    items[lo + d] |= which
            cols = [b.column(k) for k in range(n0)]
            types = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            done = [pa.array([[{"start": x, "end": y} for x, y in _merge(v)] for v in spans], types),
                    pa.array([sorted(v) for v in items], pa.list_(pa.string()))]
            if last:
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n_words), *done], [*names, "n_words", "spans", "items"])
            else:                                    # only rows with hits, without their texts
                out = pa.RecordBatch.from_arrays([*cols, *done], [*names, "spans", "items"])
                yield out.filter(pa.array([bool(v) for v in spans], pa.bool_()))

    fields = {f.name: f for f in rows.schema.fields}
    head = [fields[c] for c in names]
    middle = [StructField("n_words", LongType())] if last else []
    return map_arrow(rows, run, StructType([*head, *middle, fields["spans"], fields["items"]]))


def hit_words(spans: str = "spans"):
    """Number of words inside the merged ranges."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])


def contaminated(n_words: str = "n_words", spans: str = "spans"):
    """At least a twentieth of the words, and not none, are inside occurring windows."""
    n = hit_words(spans)
    return (n > 0) & (n * 20 >= F.col(n_words))
