"""Prefix trie of token sequences (a conversation's turns) as a z-fast trie.

A sequence is known by the 128-bit hashes of its prefixes. The trie is compacted: a node is the root, the
end of a sequence or a prefix that goes on in two ways or more; the sequence of a node is its extent, and
its edge holds the prefixes between its parent's extent and its own. A node is hashed at its handle: the
prefix of its extent whose depth is the two-fattest number (the one divisible by the largest power of two)
in (parent's depth, own depth].

* Locate: a sequence finds its exit by fat binary search. It probes the handle table with its prefix at
  the two-fattest depth of the open interval; a node whose extent the sequence has moves the lower end
  to that extent, one whose extent it has not is the exit, and a miss moves the upper end below the probe.
  That takes as many probes as the longest sequence has bits in its length. The child by the next token
  then tells how much of the exit's edge is shared.
* Insert: batches of sequences are located in the trie of those before. What of them is new is counted by
  prefix, which gives their own branching points; edges that they leave inside are cut there.
* Totals: each sequence meets the nodes on its path once. A node's smallest member, its members, leaves
  and costs below are partial sums over these.
* Expand: every prefix on an edge is a node of the result, with its edge's members.

How it runs: all steps are joins and groupings on 128-bit prefix hashes; equal sequences are one row from
the start. Prefixes that a third of all sequences share are partial sums, and their side of a join is split
by AQE, as the other side has one row for each. No group is collected: the list of members that end at a
node is hashed from pieces of at most 4,096 ids, read in order by one task without keeping them.
The only arrays are along one sequence. Steps are written to the checkpoint folder.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from veracity.llm.common import cut_lineage, map_arrow
from veracity.llm.words import MIX, mix64

KEY = "struct<a:long,b:long>"
#: Key of the prefix of no tokens.
ROOT = "named_struct('a', 0L, 'b', 0L)"
#: A piece of a node's list of members holds the ids of one stretch of 2**12 numbers.
PIECE_BITS = 12
_STEP2 = 0x9FB21C651E98DF25


def fattest(low: Column, high: Column) -> Column:
    """The two-fattest number in (low, high], for 0 <= low < high."""
    bits = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return high.bitwiseAND(F.call_function("shiftleft", F.lit(-1), bits))


def prefix_keys(rows: DataFrame, tokens: str) -> DataFrame:
    """``rows`` with ``tokens`` (array of ``struct<a, b, w>``: two hashes and a weight) replaced by ``p``,
    the keys of its prefixes by depth from 1, and ``cw``, their running weights."""
    names = [c for c in rows.columns if c != tokens]
    key_type = pa.struct([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for b in batches:
            lists = b.column(len(names))
            offsets = np.asarray(lists.offsets)
            flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
            size = np.diff(offsets)
            first = offsets[:-1] - offsets[0]
            depth = np.arange(len(flat)) - np.repeat(first, size)
            keys = []
            with np.errstate(over="ignore"):
                for name, step in (("a", MIX), ("b", _STEP2)):
                    h = mix64(np.asarray(flat.field(name)).view(np.uint64))
                    power = np.full(int(size.max(initial=0)) + 1, step, np.uint64)
                    power[0] = 1
                    power = np.cumprod(power, dtype=np.uint64)
                    run_sum = np.cumsum(h * power[depth], dtype=np.uint64)
                    before = np.concatenate(([np.uint64(0)], run_sum))[first]
                    keys.append(mix64(run_sum - np.repeat(before, size) + (depth + 1).astype(np.uint64)).view(np.int64))
            w = np.cumsum(np.asarray(flat.field("w")))
            w = w - np.repeat(np.concatenate(([0], w))[first], size)
            at = pa.array(offsets - offsets[0], pa.int32())
            p = pa.ListArray.from_arrays(at, pa.StructArray.from_arrays([pa.array(k) for k in keys], fields=list(key_type)))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k) for k in range(len(names))), p, pa.ListArray.from_arrays(at, pa.array(w, pa.int64()))],
                [*names, "p", "cw"])

    key = StructType([StructField("a", LongType()), StructField("b", LongType())])
    schema = StructType([*(rows.schema[c] for c in names), StructField("p", ArrayType(key)),
                         StructField("cw", ArrayType(LongType()))])
    return map_arrow(rows.select(*names, tokens), run, schema)


def _at(p: str, depth: Column) -> Column:
    """Key of the prefix at a depth; the root's at 0, null beyond the sequence."""
    return F.when(depth == 0, F.expr(ROOT)).otherwise(F.try_element_at(F.col(p), depth))


def _node(p: Column, parent: Column, depth: Column) -> list[Column]:
    """A node's columns from a sequence that has it, its depth and its parent's."""
    return [F.element_at(p, depth).alias("ext"), parent.alias("pe"), depth.alias("e"),
            F.element_at(p, fattest(parent, depth)).alias("handle"), F.element_at(p, parent + 1).alias("first"),
            F.slice(p, parent + 1, depth - parent).alias("edge")]


def locate(rows: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """``rows(x, n, p)`` with the depth ``l`` of the deepest node whose extent they have, ``exit``, the
    extent of the node whose edge they go on along (or null), its ``e``, and ``lcp``, where they leave."""
    rows = rows.withColumn("l", F.lit(0)).withColumn("r", F.col("n"))
    handles = nodes.select(F.col("handle").alias("probe"), F.col("ext").alias("h_ext"), F.col("e").alias("h_e"),
                           F.col("pe").alias("h_pe"))
    for _ in range(max(1, longest).bit_length()):
        f = F.when(F.col("l") < F.col("r"), fattest(F.col("l"), F.col("r")))
        rows = rows.withColumn("f", f).withColumn("probe", _at("p", F.col("f"))).join(handles, "probe", "left")
        has = _at("p", F.col("h_e")) == F.col("h_ext")
        rows = rows.select(
            "x", "n", "p",
            F.when(F.col("h_e").isNull(), F.col("l")).when(has, F.col("h_e")).otherwise(F.col("h_pe")).alias("l"),
            F.when(F.col("h_e").isNull(), F.when(F.col("f").isNull(), F.col("l")).otherwise(F.col("f") - 1))
            .when(has, F.col("r")).otherwise(F.col("h_pe")).alias("r"))
    children = nodes.select(F.col("first").alias("next"), F.col("ext").alias("exit"), "e", "edge")
    rows = rows.withColumn("next", _at("p", F.col("l") + 1)).join(children, "next", "left")
    same = F.zip_with("edge", F.slice("p", F.col("l") + 1, F.size("edge")), lambda u, v: u.eqNullSafe(v))
    shared = F.coalesce(F.when(F.col("exit").isNotNull(), F.size(F.filter(same, lambda s: s))), F.lit(0))
    return rows.select("x", "n", "p", "l", "exit", "e", (F.col("l") + shared).alias("lcp"))


def insert(nodes: DataFrame, rows: DataFrame, longest: int) -> DataFrame:
    """The trie's nodes with the sequences ``rows(x, n, p)`` in it."""
    found = cut_lineage(locate(rows, nodes, longest))
    # Edges that a sequence leaves, or ends on, before their end are cut there.
    cuts = (found.where((F.col("lcp") > F.col("l")) & (F.col("lcp") < F.col("e"))).groupBy(F.col("exit").alias("ext"))
            .agg(F.sort_array(F.collect_set("lcp")).alias("cuts")))
    old = nodes.join(cuts, "ext", "left")
    ends = F.concat(F.coalesce("cuts", F.array().cast("array<int>")), F.array("e"))
    old = old.select("pe", "edge", F.explode(F.arrays_zip(
        F.concat(F.array("pe"), F.slice(ends, 1, F.size(ends) - 1)).alias("low"), ends.alias("high"))).alias("s"))
    low, high = F.col("s.low") - F.col("pe"), F.col("s.high") - F.col("pe")
    part = [c.alias(n) for c, n in zip(_node(F.col("edge"), low, high), ("ext", "pe", "e", "handle", "first", "edge"))]
    # The fattest depth is one of the whole sequence, not of the edge.
    part[3] = F.element_at("edge", fattest(F.col("s.low"), F.col("s.high")) - F.col("pe")).alias("handle")
    part[1], part[2] = F.col("s.low").alias("pe"), F.col("s.high").alias("e")
    old = old.select(*part)
    # New prefixes: nodes where a sequence ends or two go on in different ways.
    new = found.where(F.col("lcp") < F.col("n")).select("x", "n", "p", "lcp")
    steps = new.select("x", "n", F.explode(F.sequence(F.col("lcp") + 1, F.col("n"))).alias("d"), "p").select(
        "x", "d", (F.col("d") == F.col("n")).alias("ends"), _at("p", F.col("d")).alias("key"),
        _at("p", F.col("d") + 1).alias("next"))
    points = steps.groupBy("key").agg(
        F.min("x").alias("owner"), F.max("ends").alias("ends"), F.min("next.a").alias("a0"), F.max("next.a").alias("a1"),
        F.min("next.b").alias("b0"), F.max("next.b").alias("b1"))
    points = points.where(F.col("ends") | (F.col("a0") != F.col("a1")) | (F.col("b0") != F.col("b1"))).select("key", "owner")
    path = (steps.select("x", "d", "key").join(points, "key").groupBy("x")
            .agg(F.sort_array(F.collect_list(F.struct("d", (F.col("owner") == F.col("x")).alias("own")))).alias("path")))
    depths = F.transform("path", lambda s: s["d"])
    made = new.join(path, "x").select("p", F.explode(F.arrays_zip(
        F.concat(F.array("lcp"), F.slice(depths, 1, F.size(depths) - 1)).alias("low"), depths.alias("high"),
        F.transform("path", lambda s: s["own"]).alias("own"))).alias("s")).where("s.own")
    made = made.select(*_node(F.col("p"), F.col("s.low"), F.col("s.high")))
    return cut_lineage(old.unionByName(made))


def build(rows: DataFrame, longest: int, batches: int) -> DataFrame:
    """The compacted trie (without its root) of distinct sequences ``rows(x, n, p)``, batch by batch."""
    nodes = rows.sparkSession.createDataFrame(
        [], f"ext {KEY}, pe int, e int, handle {KEY}, first {KEY}, edge array<{KEY}>")
    for k in range(batches):
        nodes = insert(nodes, rows.where(F.pmod(F.xxhash64("x"), F.lit(batches)) == k), longest)
    return nodes


def member_digests(members: DataFrame) -> DataFrame:
    """``members(key, id)`` -> ``(key, digest)``: SHA-256 of the ids in ascending order, comma-joined.

    Ids of a stretch of 4,096 numbers make a piece; one task reads a key's pieces in order and keeps
    nothing of them but the hash."""
    piece = F.shiftright("id", PIECE_BITS)
    pieces = (members.groupBy("key", piece.alias("piece"))
              .agg(F.array_join(F.sort_array(F.collect_list("id")).cast("array<string>"), ",").alias("ids"))
              .select(F.col("key.a").alias("a"), F.col("key.b").alias("b"), "piece", "ids"))
    pieces = pieces.repartition("a", "b").sortWithinPartitions("a", "b", "piece")

    def run(batches):
        now, digest, done = None, None, []
        for batch in batches:
            for a, b, ids in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), batch["ids"]):
                if (a, b) != now:
                    if now is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = (a, b), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.as_py().encode())
            yield _digests(done)
            done = []
        if now is not None:
            yield _digests([(*now, digest.hexdigest())])

    def _digests(done):
        a, b, d = zip(*done) if done else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(d, pa.string())],
                                          ["a", "b", "digest"])

    return map_arrow(pieces.select("a", "b", "ids"), run, "a long, b long, digest string").select(
        F.struct("a", "b").alias("key"), "digest")


def prefix_trie(sequences: DataFrame, id_col: str, tokens_col: str, batches: int = 3) -> DataFrame:
    """All prefixes of ``sequences`` (unique ids; ``tokens_col`` as in :func:`prefix_keys`) as rows: ``id``
    (smallest member), ``depth``, ``parent_id``, ``n_members``, ``n_children``, ``n_leaves``, ``saved`` (over the
    subtree, each prefix's (members - 1) times its last token's weight) and ``ends_sha256``."""
    seqs = cut_lineage(prefix_keys(sequences.select(F.col(id_col).alias("id"), F.col(tokens_col).alias("tokens")), "tokens"))
    whole = seqs.withColumn("n", F.size("p")).withColumn("key", _at("p", F.size("p")))
    digests = member_digests(whole.select("key", "id"))
    distinct = whole.groupBy("key").agg(F.min("id").alias("x"), F.count(F.lit(1)).alias("copies"))
    distinct = cut_lineage(distinct.join(seqs.withColumnRenamed("id", "x"), "x").select(
        "x", "copies", F.size("p").alias("n"), "p", "cw"))
    top = distinct.agg(F.min("x").alias("id"), F.sum("copies").alias("members"), F.max("n").alias("n")).first()
    longest = top["n"] or 0
    nodes = build(distinct.where("n > 0").select("x", "n", "p"), longest, batches if longest else 1)

    # Each sequence and the nodes on its path; a node's owner is its smallest member.
    path = distinct.where("n > 0").select(
        "x", "copies", "n", F.posexplode(F.arrays_zip("p", "cw")).alias("k", "s")).select(
        "x", "copies", "n", (F.col("k") + 1).alias("e"), F.col("s.p").alias("ext"), F.col("s.cw").alias("w"))
    path = cut_lineage(path.join(nodes.select("ext"), "ext"))
    held = path.groupBy("ext").agg(F.min("x").alias("owner"), F.sum("copies").alias("members"),
                                   F.max(F.col("n") > F.col("e")).alias("deeper"))
    down = Window.partitionBy("x").orderBy("e")
    own = F.col("owner") == F.col("x")
    path = path.join(held, "ext").select(
        "x", "ext", "e", "owner", "members", "deeper", own.alias("own"), F.lead(own, 1, False).over(down).alias("bears"),
        F.coalesce(F.lag("owner").over(down), F.lit(top["id"])).alias("parent"), F.lag("e", 1, 0).over(down).alias("pe"),
        (F.col("w") - F.lag("w", 1, 0).over(down)).alias("dw"))
    below = Window.partitionBy("x").orderBy(F.desc("e"))
    cost = F.when(F.col("own"), (F.col("members") - 1) * F.col("dw")).otherwise(0)
    path = cut_lineage(path.select(
        "x", "ext", "e", "pe", "parent", "members", "own", F.col("bears").cast("long").alias("bears"),
        F.sum(cost).over(below).alias("saved"),
        F.sum((F.col("own") & ~F.col("deeper")).cast("long")).over(below).alias("leaves")))
    sums = path.groupBy("ext").agg(F.sum("bears").alias("children"), F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    full = path.where("own").select("x", "ext", "e", "pe", "parent", "members").join(sums, "ext")
    full = cut_lineage(full.join(digests.withColumnRenamed("key", "ext"), "ext", "left"))

    empty = hashlib.sha256(b"").hexdigest()
    rows = full.join(distinct.select("x", "cw"), "x").select("*", F.explode(F.sequence(F.col("pe") + 1, F.col("e"))).alias("d"))
    above = F.when(F.col("d") == 1, 0).otherwise(F.try_element_at("cw", F.col("d") - 1))
    base = F.when(F.col("pe") == 0, 0).otherwise(F.try_element_at("cw", F.col("pe")))
    tip = F.col("d") == F.col("e")
    rows = rows.select(
        F.col("x").alias("id"), F.col("d").cast("long").alias("depth"),
        F.when(F.col("d") == F.col("pe") + 1, F.col("parent")).otherwise(F.col("x")).alias("parent_id"),
        F.col("members").alias("n_members"), F.when(tip, F.col("children")).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("saved") - (F.col("members") - 1) * (above - base)).alias("saved"),
        F.when(tip, F.coalesce("digest", F.lit(empty))).otherwise(F.lit(empty)).alias("ends_sha256"))
    if top["id"] is None:
        return rows
    tops = full.where("pe = 0").agg(F.count(F.lit(1)).alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    rooted = digests.where(F.col("key") == F.expr(ROOT)).agg(F.max("digest").alias("digest"))
    root = tops.crossJoin(rooted).select(           # one row each
        F.lit(top["id"]).cast(rows.schema["id"].dataType).alias("id"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast(rows.schema["id"].dataType).alias("parent_id"), F.lit(top["members"]).cast("long").alias("n_members"),
        F.col("children").alias("n_children"), F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).cast("long").alias("saved"), F.coalesce("digest", F.lit(empty)).alias("ends_sha256"))
    return rows.unionByName(root)


def turn_sequences(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """``(conv, tokens)``: each conversation's turns in order (null turn first; equal ones by role and text)
    as tokens whose hashes are of role and text and whose weight is the text's words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                                role.alias("role"), text.alias("text")).where(F.col("conv").isNotNull())
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "role", "text")
    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    rows = rows.select("conv", F.row_number().over(order).alias("k"), F.xxhash64("role", "text").alias("a"),
                       F.xxhash64(F.lit(7), "text", "role").alias("b"), words.cast("long").alias("w"))
    turns = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("k", "a", "b", "w"))).alias("turns"))
    return turns.select("conv", F.transform("turns", lambda t: F.struct(
        t["a"].alias("a"), t["b"].alias("b"), t["w"].alias("w"))).alias("tokens"))
