"""N-gram Jaccard join: documents whose sets of word shingles are similar, and their groups.

Method: prefix filtering with the rarest shingles first. Two sets with similarity of at least t
share at least l of their first ``n - ceil(t n) + l`` shingles in any common order, so only these
prefix shingles are joined; ordering them by corpus frequency keeps common passages out of the
prefixes, and l grows with the set (``1 + n / 40``), so that long texts need more than a chance
meeting. Length, positional and suffix filters drop pairs that cannot reach the bound, and what is
left is verified on the whole sets, once per pair.

How it runs:

1. One pass hashes each text to its set, keeps the set's size and 128-bit signature, and counts
   shingles in a table of fixed size (hashed counters over all documents: an upper bound of the
   frequency, used for the order only, so a collision costs time and never a link).
2. Documents with one signature are one class and take part once, however many copies there are.
3. A prefix shingle of one class joins nothing. A bitmap of bounded size tells which are shared:
   tasks sort the high 32 bits of their shingles and send the gaps, and what occurs twice is found
   range by range in arrays of bounded size. Its errors let rows through and lose none.
4. First links: in each group of classes with a common prefix shingle and like sizes, every class
   meets the one with the fewest shingles of its own. A group of n near copies costs n pairs, not n squared.
5. Remaining links: all classes of one group that step 4 has not connected, and only those, meet
   each other. A pair inside one component adds nothing to it and is never formed.
6. Components by star contraction; every copy takes its class's component.

Defined cases: null, empty or wordless text has an empty set, is linked with nothing and is its
own component. A text of fewer words than a shingle is one shingle. Rows that repeat an id are
one node of the graph. A null id never names a component: its row takes that of its class, or
null. Columns other than the id and the text are neither needed nor read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from veracity.llm import words as W
from veracity.llm.common import binary_buffers, bitmap_of, byte_steps, cut_lineage, in_bitmap, map_arrow
from veracity.llm.components import connected_components

#: Hashed frequency counters, bits of the bitmap of shared shingles and of the one of candidate
#: classes: fixed, whatever the input (a fuller bitmap lets more rows through, and loses none).
LOG2_COUNTERS = 18
LOG2_SHARED = 27
LOG2_NODES = 24
#: Shared shingles are found by their high 32 bits, in so many ranges.
_LOG2_RANGES = 10
_LOG2_RANGE = 32 - _LOG2_RANGES
_BLOCK = 4096
#: Buckets of the suffix filter: a pair's overlap is at most the sum of the smaller bucket counts.
_BUCKETS = 64
#: A set of n shingles must share ``1 + n // _STEP`` prefix shingles with a similar one.
_STEP = 40


def _sets(batch: pa.RecordBatch, column: int, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, the rows' sets one after the other, where each begins) a step of texts at a time."""
    data, offsets = binary_buffers(batch.column(column))
    for lo, hi in byte_steps(offsets):
        h, first, _, _ = W.words(data, offsets[lo:hi + 1], W.SPACED)
        yield lo, *W.shingle_sets(h, first, size)


def _signatures(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """128 bits of each set (a row each); equal sets have equal ones, empty ones have zeros."""
    n = np.diff(at)
    out = np.zeros((len(n), 2), np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        with np.errstate(over="ignore"):
            salt = np.repeat(n.astype(np.uint64) * np.uint64(W.MIX), n)
            a = W.mix64(flat ^ salt)
            out[full, 0] = np.add.reduceat(a, at[full])
            out[full, 1] = np.add.reduceat(W.mix64(a + flat), at[full])
            out = W.mix64(out)
    return out.view(np.int64)


def _bucket(s: np.ndarray) -> np.ndarray:
    return (W.mix64(s) >> np.uint64(64 - LOG2_COUNTERS)).astype(np.int64)


def shingle_profiles(docs: DataFrame, text_col: str, size: int) -> tuple[DataFrame, np.ndarray]:
    """Per row of ``docs(id, text)``: ``(id, n, s1, s2)``, and the corpus's hashed frequencies."""
    id_type = docs.schema["id"].dataType

    def run(batches):
        counts = np.zeros(1 << LOG2_COUNTERS, np.uint32)
        none = pa.nulls(0)
        for b in batches:
            n, sig = np.zeros(b.num_rows, np.int64), np.zeros((b.num_rows, 2), np.int64)
            for lo, flat, at in _sets(b, 1, size):
                n[lo:lo + len(at) - 1] = np.diff(at)
                sig[lo:lo + len(at) - 1] = _signatures(flat, at)
                counts += np.bincount(_bucket(flat), minlength=len(counts)).astype(np.uint32)
            none = b.column(0).slice(0, 0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n), pa.array(sig[:, 0].copy()), pa.array(sig[:, 1].copy()), pa.nulls(b.num_rows, pa.int32()),
                 pa.nulls(b.num_rows, pa.binary())], ["id", "n", "s1", "s2", "block", "counts"])
        blocks = [k for k in range(len(counts) // _BLOCK) if counts[k * _BLOCK:(k + 1) * _BLOCK].any()]
        if blocks:
            m = len(blocks)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, none.type), *[pa.nulls(m, pa.int64())] * 3, pa.array(blocks, pa.int32()),
                 pa.array([counts[k * _BLOCK:(k + 1) * _BLOCK].tobytes() for k in blocks], pa.binary())],
                ["id", "n", "s1", "s2", "block", "counts"])

    schema = StructType([StructField("id", id_type), *[StructField(c, LongType()) for c in ("n", "s1", "s2")],
                         StructField("block", IntegerType()), StructField("counts", BinaryType())])
    out = cut_lineage(map_arrow(docs.select("id", text_col), run, schema))
    parts = out.where("block is not null").select("block", "counts")

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[k] = total.get(k, 0) + np.frombuffer(c, np.uint32).astype(np.uint64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
            ["block", "counts"])

    table = np.zeros(1 << LOG2_COUNTERS, np.uint64)          # bounded: 2 MB, whatever the input
    for r in map_arrow(parts.repartition(64, "block"), add, "block int, counts binary").collect():
        table[r["block"] * _BLOCK:(r["block"] + 1) * _BLOCK] = np.frombuffer(bytes(r["counts"]), np.uint64)
    return out.where("block is null").drop("block", "counts"), table


def _prefix_rows(docs: DataFrame, text_col: str, size: int, pct: int, freq, only=None) -> DataFrame:
    """The rarest-first prefix of each set, (s1, s2, n, alone, buckets, tokens, places) of the shingles
    that may be in the bitmap ``only``; a task emits a set once. ``alone`` counts the set's other
    prefix shingles, and ``buckets`` serves the suffix filter (null beyond a million).

    Without ``only``: rows (part, wide, gaps) for ``_shared_bitmap``.
    """
    def prefixes(batches):
        """Steps of (signature, n, tokens, positions, set) of the sets not seen before."""
        counts, seen = freq.value, set()
        for b in batches:
            for _, flat, at in _sets(b, 0, size):
                sigs, rank, out = _signatures(flat, at), counts[_bucket(flat)], []
                for i in np.flatnonzero(np.diff(at)):
                    s, f, n = flat[at[i]:at[i + 1]], rank[at[i]:at[i + 1]], int(at[i + 1] - at[i])
                    sig = (int(sigs[i, 0]), int(sigs[i, 1]))
                    if sig in seen:                  # a copy: its class is already in this task's output
                        continue
                    if len(seen) >= 500_000:         # bounded; a class emitted twice is merged later
                        seen.clear()
                    seen.add(sig)
                    k = n + (-pct * n // 100) + 1 + n // _STEP        # n - ceil(t n) + l
                    near = np.flatnonzero(f <= np.partition(f, k - 1)[k - 1]) if k < n else np.arange(n)
                    out.append((sig, n, s[near[np.lexsort((s[near], f[near]))][:k]], np.arange(k), s))
                if out:
                    yield out

    def gaps(batches):
        held, size_ = [], 0

        def flush():
            at = np.sort(np.concatenate(held)) if held else np.empty(0, np.uint32)
            starts = np.arange((1 << _LOG2_RANGES) + 1, dtype=np.uint64) << np.uint64(_LOG2_RANGE)
            edges = np.searchsorted(at, starts)
            part = [(k, np.diff(at[a:b], prepend=np.uint32(k << _LOG2_RANGE)))
                    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if a < b]
            wide = [bool(d.max() > 0xFFFF) for _, d in part]
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in part], pa.int32()), pa.array(wide, pa.bool_()),
                 pa.array([(d if w else d.astype(np.uint16)).tobytes() for w, (_, d) in zip(wide, part)], pa.binary())],
                ["part", "wide", "gaps"])

        for out in prefixes(batches):
            held += [(x[2] >> np.uint64(32)).astype(np.uint32) for x in out]
            size_ += sum(len(x[2]) for x in out)
            if size_ > 4_000_000:
                yield flush()
                held, size_ = [], 0
        yield flush()

    def rows(batches):
        keep = only.value
        for out in prefixes(batches):
            part = []
            for sig, n, t, p, s in out:
                hit = in_bitmap(keep, t, LOG2_SHARED)
                if hit.any():
                    count = np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=_BUCKETS)
                    small = n <= 1_000_000 and count.max() < 32768
                    part.append((sig, n, len(t) - int(hit.sum()), count.astype(np.int16) if small else None,
                                 t[hit].view(np.int64), p[hit].astype(np.int32)))
            if part:
                sig = np.array([x[0] for x in part], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig[:, 0].copy()), pa.array(sig[:, 1].copy()), pa.array([x[1] for x in part], pa.int64()),
                     pa.array([x[2] for x in part], pa.int64()), pa.array([x[3] for x in part], pa.list_(pa.int16())),
                     pa.array([x[4] for x in part], pa.list_(pa.int64())), pa.array([x[5] for x in part], pa.list_(pa.int32()))],
                    ["s1", "s2", "n", "alone", "buckets", "tokens", "places"])

    if only is None:
        return map_arrow(docs.select(text_col), gaps, "part int, wide boolean, gaps binary")
    return map_arrow(docs.select(text_col), rows, "s1 long, s2 long, n long, alone long, buckets array<short>, "
                     "tokens array<long>, places array<int>")


def _shared_bitmap(gaps: DataFrame) -> np.ndarray:
    """The bitmap (``2**LOG2_SHARED`` bits) of prefix shingles that occur more than once."""
    shift = np.int64(32 - LOG2_SHARED)

    def shared(batches):
        part, once, twice = None, np.zeros(1 << _LOG2_RANGE, bool), np.zeros(1 << _LOG2_RANGE, bool)

        def done():
            bits = np.zeros(1 << (_LOG2_RANGE - int(shift)), bool)
            bits[np.flatnonzero(twice) >> shift] = True
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())],
                ["part", "bits"])

        for b in batches:                              # sorted by part: one range in memory at a time
            for k, wide, g in zip(*(b.column(c).to_pylist() for c in range(3))):
                if k != part:
                    if part is not None:
                        yield done()
                    part = k
                    once[:], twice[:] = False, False
                at = np.cumsum(np.frombuffer(g, np.uint32 if wide else np.uint16), dtype=np.int64)
                twice[at[once[at]]] = True
                twice[at[1:][at[1:] == at[:-1]]] = True
                once[at] = True
        if part is not None:
            yield done()

    out = np.zeros(1 << (LOG2_SHARED - 3), np.uint8)
    size = 1 << (_LOG2_RANGE - int(shift) - 3)
    dealt = gaps.repartition(64, "part").sortWithinPartitions("part")
    for r in map_arrow(dealt, shared, "part int, bits binary").collect():
        out[r["part"] * size:(r["part"] + 1) * size] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def _set_rows(docs: DataFrame, text_col: str, size: int, nodes) -> DataFrame:
    """(s1, s2, shingles) of the sets whose signature may be in the bitmap ``nodes``."""
    def run(batches):
        keep, seen = nodes.value, set()
        for b in batches:
            for _, flat, at in _sets(b, 0, size):
                sigs, rows = _signatures(flat, at), []
                for i in np.flatnonzero(in_bitmap(keep, sigs[:, 0].copy(), LOG2_NODES) & (np.diff(at) > 0)):
                    s, sig = flat[at[i]:at[i + 1]], (int(sigs[i, 0]), int(sigs[i, 1]))
                    if sig in seen:
                        continue
                    if len(seen) >= 500_000:
                        seen.clear()
                    seen.add(sig)
                    rows.append((sig, s.view(np.int64)))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[0][0] for r in rows], pa.int64()), pa.array([r[0][1] for r in rows], pa.int64()),
                         pa.array([r[1] for r in rows], pa.list_(pa.int64()))], ["s1", "s2", "shingles"])
    return map_arrow(docs.select(text_col), run, "s1 long, s2 long, shingles array<long>")


def _reach(na, nb, pct: int):
    """Least overlap of sets of these sizes with similarity of pct/100: ceil(pct (na+nb) / (100+pct))."""
    return F.floor(((na + nb) * pct + (99 + pct)) / F.lit(100 + pct))


def _least_common(n):
    """Prefix shingles that a set of n must share with a similar one of its size or more."""
    return F.floor(n / _STEP) + 1


def _may_link(a: str, b: str, pct: int):
    """Length, prefix and positional filters for two rows that share a shingle.

    The pair needs an overlap of o, so it shares l shingles within the first ``n - o + l`` of each
    set; later positions need not be looked at for this pair.
    """
    na, nb, pa_, pb = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.pos"), F.col(f"{b}.pos")
    o, l = _reach(na, nb, pct), _least_common(F.least(na, nb))
    most = F.least(pa_, pb) + 1 + F.least(na - pa_ - 1, nb - pb - 1)
    return ((na * 100 >= nb * pct) & (nb * 100 >= na * pct) & (pa_ < na - o + l) & (pb < nb - o + l)
            & (most >= o))


def _suffix_filter(pairs: DataFrame, parts: DataFrame, pct: int) -> DataFrame:
    """Pairs that can reach the bound: the overlap is at most the sum over hash buckets of the
    smaller count. Sets too large for bucket counts stay in."""
    p = pairs.join(parts.toDF("a", "na", "ba"), "a", "left").join(parts.toDF("b", "nb", "bb"), "b", "left")
    most = F.expr("aggregate(zip_with(ba, bb, (x, y) -> cast(least(x, y) as long)), 0L, (s, x) -> s + x)")
    return p.where((most >= _reach(F.col("na"), F.col("nb"), pct)) | most.isNull()).select("a", "b")


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, size: int, pct: int) -> DataFrame:
    """Of distinct pairs ``(a, b)`` of class ids those whose whole sets are similar enough.

    Sets are made only for the classes of these pairs (found by a bitmap of bounded size: extra
    ones fall out of the join).
    """
    spark = docs.sparkSession
    ends = pairs.select("a", "b", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("a").alias("node")),
        F.struct(F.lit(1).alias("side"), F.col("b").alias("node")))).alias("e")).select("a", "b", "e.*")
    ends = ends.join(classes, "node").select("a", "b", "side", "s1", "s2")
    nodes = spark.sparkContext.broadcast(bitmap_of(ends.select("s1").distinct(), "s1", LOG2_NODES))
    sets = _set_rows(docs, "text", size, nodes).join(ends, ["s1", "s2"])
    both = sets.groupBy("a", "b").agg(*[F.first(F.when(F.col("side") == k, F.col("shingles")), ignorenulls=True)
                                        .alias(c) for k, c in enumerate(("sa", "sb"))])
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(common * 100 >= (F.size("sa") + F.size("sb") - common) * pct).select("a", "b")


def similar_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                    pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """(members, links): ``members(id, n, node)`` gives each row's set size and class (null for an
    empty set); ``links(a, b)`` connects every two classes that a chain of links connects."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    profiles, table = shingle_profiles(docs, "text", size)
    freq = spark.sparkContext.broadcast(table)
    classes = profiles.where("n > 0").groupBy("s1", "s2").agg(F.min("id").alias("first"))
    classes = cut_lineage(classes.select("s1", "s2", F.monotonically_increasing_id().alias("node")))
    members = profiles.join(classes, ["s1", "s2"], "left").select("id", "n", "node")

    bitmap = spark.sparkContext.broadcast(_shared_bitmap(_prefix_rows(docs, "text", size, pct, freq)))
    one = _prefix_rows(docs, "text", size, pct, freq, bitmap).join(classes, ["s1", "s2"])
    raw = cut_lineage(one.groupBy("s1", "s2", "node").agg(
        *[F.first(c).alias(c) for c in ("n", "alone", "buckets", "tokens", "places")]).drop("s1", "s2"))
    parts = raw.select("node", "n", "buckets")

    def exploded(sets: DataFrame) -> DataFrame:
        own = [c for c in sets.columns if c not in ("tokens", "places", "buckets")]
        e = F.explode_outer(F.arrays_zip("tokens", "places")).alias("e")
        return sets.select(*own, e).select(*own, F.col("e.tokens").alias("token"), F.col("e.places").cast("long").alias("pos"))

    rows = exploded(raw)

    # First links: like sizes (a factor of 1 / t a band) meet the class of their group with the fewest
    # shingles of its own, which the others were most likely made from.
    rows = rows.withColumn("band", F.floor(F.log(F.col("n")) / F.log(F.lit(100 / pct))))
    pivot = (rows.groupBy("token", "band").agg(F.min(F.struct("alone", "n", "node", "pos")).alias("p"), F.count(F.lit(1)).alias("c"))
             .where("c > 1").select("token", "band", "p.*"))
    pairs = (rows.alias("x").join(pivot.alias("y"), ["token", "band"])
             .where(F.col("x.node") != F.col("y.node")).where(_may_link("x", "y", pct))
             .groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
             .agg(F.count(F.lit(1)).alias("k"), F.min(F.least("x.n", "y.n")).alias("n"))
             .where(F.col("k") >= _least_common(F.col("n"))))
    best = pairs.groupBy("a").agg(F.max(F.struct("k", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
    best = cut_lineage(_suffix_filter(best, parts, pct))
    first = cut_lineage(_verified(best, docs, classes, size, pct))
    known = connected_components(first)

    # Remaining links: within a group, only classes of different components so far.
    # The group's main component (the largest of all) need not look at its own members again.
    sizes = known.join(known.groupBy("component").agg(F.count(F.lit(1)).alias("c")), "component")
    labelled = exploded(raw.drop("alone", "buckets").join(sizes, "node", "left")
                        .withColumn("label", F.coalesce("component", "node")).drop("component"))
    main = (labelled.groupBy("token").agg(
        F.max(F.struct(F.coalesce("c", F.lit(1)).alias("c"), F.col("label").alias("main"))).alias("m"),
        F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("token", "m.main"))
    mixed = cut_lineage(labelled.select("token", "node", "n", "pos", "label").join(main, "token"))
    x, y = mixed.where("label <> main").alias("x"), mixed.alias("y")
    rest = (x.join(y, F.col("x.token") == F.col("y.token"))
            .where((F.col("x.label") != F.col("y.label"))
                   & ((F.col("y.label") == F.col("y.main")) | (F.col("x.node") < F.col("y.node"))))
            .where(_may_link("x", "y", pct))
            .groupBy(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b"))
            .agg(F.count(F.lit(1)).alias("k"), F.min(F.least("x.n", "y.n")).alias("n"))
            .where(F.col("k") >= _least_common(F.col("n"))).select("a", "b"))
    tried = best.unionByName(best.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest = cut_lineage(_suffix_filter(rest, parts, pct).join(tried, ["a", "b"], "left_anti"))
    if rest.isEmpty():
        return members, first
    return members, cut_lineage(first.unionByName(_verified(rest, docs, classes, size, pct)))


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                   pct: int = 80) -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_shingles, component_id`` (smallest id reachable by
    links of similarity of at least ``pct``/100, its own included)."""
    members, links = similar_classes(docs, id_col, text_col, size, pct)
    groups = connected_components(links)
    m = members.join(groups, "node", "left").withColumn("g", F.coalesce("component", "node"))
    least = m.where("g is not null").groupBy("g").agg(F.min("id").alias("least"))
    # Rows of an empty set have no group: they are dealt by nothing and kept beside the join.
    full = m.where("g is not null").join(least, "g")
    own = m.where("g is null").withColumn("least", F.col("id"))
    out = full.select("id", "n", "least").unionByName(own.select("id", "n", "least"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))
