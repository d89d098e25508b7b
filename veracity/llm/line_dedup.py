"""Line dedup across documents: a deletion-neighbourhood join on words, keeping the earliest line.

A line is its sequence of words (runs of anything but white space). Two lines are duplicates when
their words are equal, or when both have at least ``min_words`` words and one edit (a word put in,
taken out or replaced) makes them equal. The bound is one word at every length, not a similarity:
lines of ten words or more that differ in two words stay, though 0.8 or more of them agrees. A line
is dropped when an equal or one-edit line stands earlier, by document id and line number; whether
that line itself stays does not matter, so the decision is the same on any partitioning. Lines
without words are layout and stay.

Method: every line would emit all variants with one word deleted, as hashed keys; two lines of one
length that differ in word i have the same variant i, and a longer line has the shorter one among
its variants. Before that, a loss-free screen: one edit leaves the first or the second half of the
words untouched, so only lines that share a half (at the lengths that can meet) with a different
line emit variants, and only for the other half's positions. Equal variants are joined with the
earliest line of their key, never with each other, and the pair's words are compared to verify the
distance. A key that a third of all lines share costs one row a line and is pre-aggregated.

Everything is DataFrame functions. The screen's shared halves, and the places of the lines that
pass it, are held in bitmaps of fixed size (one value, a scalar subquery); what they let through by
mistake fails the exact joins. Only lines that pass are split into words again.

Defined cases: null text counts as empty and stays null; line ends are line feeds; rows that
repeat an id and its text are one document; an empty table gives no rows; a null id sorts first.
Other columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.llm.common import cut_lineage

#: Bits of a bitmap (8 MB, whatever the number of lines), built in rows of 2**15 bits.
LOG2_BITS = 26
_ROW_BITS = 15
_ID, _TH, _NO = "__id", "__th", "__no"


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(__id, __th, __no, line), other white space than line feeds as spaces."""
    # The text's hash and its split stay below the generator, once a document. All generators here
    # are outer ones: for the others Spark infers a filter that works out their input once more.
    text = F.col(text_col)
    for white in "\t\x0b\x0c\r":                                # then one plain character splits, no pattern
        text = F.when(F.contains(F.col(text_col), F.lit(white)), F.replace(text, F.lit(white), F.lit(" "))).otherwise(text)
    rows = docs.select(F.col(id_col).alias(_ID), F.xxhash64(text_col).alias(_TH), F.split(text, "\n").alias("lines"))
    return rows.select(_ID, _TH, F.posexplode_outer("lines").alias(_NO, "line"))


def _words() -> Column:
    return F.array_remove(F.split("line", " "), "").alias("w")


def _hashed(lines: DataFrame, min_words: int) -> DataFrame:
    """(__id, __th, __no, n, h1, h2, keys): each line's number of words, 128-bit hash and half keys."""
    rows = lines.select(_ID, _TH, _NO, _words())
    rows = rows.select("*", F.size("w").alias("n"), F.xxhash64("w").alias("h1"), F.xxhash64(F.lit(1), "w").alias("h2"))
    return rows.select(_ID, _TH, _NO, "n", "h1", "h2", _keys(min_words))


def _half_keys() -> Column:
    """Hashes of the halves that one edit leaves untouched, at the line's own length (partners of
    this length or one word longer) and at one word less (partners one word shorter)."""
    def pair(m: str) -> list[str]:
        first = f"{m} div 2"
        rest = f"({m} - {first})"
        return [f"xxhash64('p', {m}, slice(w, 1, cast({first} as int)))",
                f"xxhash64('s', {m}, slice(w, cast(n - {rest} + 1 as int), cast({rest} as int)))"]
    return F.expr(f"array({', '.join(pair('n') + pair('(n - 1)'))})")


def _keys(min_words: int) -> Column:
    # Short lines get no keys (a filter instead would be pushed down and split each line once more).
    return F.when(F.col("n") >= min_words, _half_keys()).alias("keys")


def _bitmap(keys: DataFrame) -> Column:
    """The bitmap of the hashed ``key`` as one value: 2**LOG2_BITS bits in an array of longs."""
    # The first bit of every row is set, so that no row is missing.
    first = keys.sparkSession.range(1 << (LOG2_BITS - _ROW_BITS)).select(F.shiftleft("id", _ROW_BITS).alias("b"))
    rows = (keys.select(F.shiftrightunsigned("key", 64 - LOG2_BITS).alias("b")).unionAll(first)
            .groupBy(F.shiftright("b", _ROW_BITS).alias("row"))
            .agg(F.bitmap_construct_agg(F.col("b").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))).alias("bits")))

    def four_bytes(at: Column) -> Column:
        return F.conv(F.hex(F.substring("bits", at, F.lit(4))), 16, 10).cast("long")
    longs = F.transform(F.sequence(F.lit(1), F.lit(1 << (_ROW_BITS - 3)), F.lit(8)),
                        lambda at: F.shiftleft(four_bytes(at), 32).bitwiseOR(four_bytes(at + 4)))
    rows = rows.select("row", longs.alias("bits")).agg(F.sort_array(F.collect_list(F.struct("row", "bits"))).alias("rows"))
    return cut_lineage(rows.select(F.flatten("rows.bits").alias("bits"))).scalar()


def _in_bitmap(bits: Column, key: Column) -> Column:
    b = F.shiftrightunsigned(key, 64 - LOG2_BITS)
    # Bytes are in order and bits of a byte from its low end, bytes of a long from its high end.
    place = b.bitwiseAND(F.lit(63)).bitwiseXOR(F.lit(56)).cast("int")
    word = F.get(bits, F.shiftright(b, 6).cast("int"))
    return F.call_function("shiftrightunsigned", word, place).bitwiseAND(F.lit(1)) == 1


def _candidates(hashed: DataFrame) -> DataFrame:
    """First places of the lines that share a half with a different line, numbered in the order of
    the documents: (c, __id, __th, __no, n, sides), ``sides`` with a bit for each half."""
    halves = hashed.select(_ID, _TH, _NO, "n", "h1", "h2", F.posexplode_outer("keys").alias("side", "key"))
    both = (halves.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"))
            .where("key is not null and lo <> hi"))
    found = (halves.where(_in_bitmap(_bitmap(both), F.col("key"))).groupBy("h1", "h2")
             .agg(F.min(F.struct(_ID, _TH, _NO)).alias("at"), F.first("n").alias("n"),
                  F.bit_or(F.expr("shiftleft(1, side)")).alias("sides")))
    # The smallest number is the earliest line.
    return cut_lineage(found.select("at.*", "n", "sides").orderBy(_ID, _TH, _NO)
                       .select(F.monotonically_increasing_id().alias("c"), _ID, _TH, _NO, "n", "sides"))


def _same_place(a: str, b: str) -> list[Column]:
    return [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in (_ID, _TH, _NO)]


def _with_words(cand: DataFrame, lines: DataFrame) -> DataFrame:
    """(c, n, sides, w): only lines at a candidate's place are split into words."""
    at = F.xxhash64(_TH, _NO)
    some = lines.where(_in_bitmap(_bitmap(cand.select(at.alias("key"))), at)).select(_ID, _TH, _NO, _words())
    rows = cand.alias("c").join(some.alias("l"), _same_place("c", "l")).select("c", "n", "sides", "w")
    return rows.dropDuplicates(["c"])                           # of rows that repeat an id and its text


def _with_variant_keys(cand: DataFrame) -> DataFrame:
    """Adds ``whole``, the key of a line, and ``keys``: that of the line without its word i, for
    each i. A key is the exclusive or of the hashes of (word, place), so a deletion changes a prefix
    not at all and moves the rest by one place; sums over blocks of sqrt(n) words keep the work for
    a line of n words at n * sqrt(n)."""
    xor = "0L, (s, x) -> s ^ x"
    step, last = "cast(ceil(sqrt(n)) as int)", "least(n, (t.b + 1) * step)"
    cand = cand.withColumn("hw", F.transform("w", lambda x: F.xxhash64(x)))
    rows = cand.select("*", F.expr("transform(hw, (x, j) -> xxhash64(x, j))").alias("f0"),
                       F.expr("transform(hw, (x, j) -> xxhash64(x, j - 1))").alias("f1"), F.expr(step).alias("step"))
    rows = rows.select("*", F.expr(
        "transform(sequence(0, (n - 1) div step), b -> named_struct('b', cast(b as int), "
        f"'pre', aggregate(slice(f0, 1, cast(b * step as int)), {xor}), "
        f"'post', aggregate(slice(f1, cast((b + 1) * step + 1 as int), n), {xor})))").alias("blocks"))
    return rows.select("c", "n", "sides", F.expr(f"aggregate(f0, {xor})").alias("whole"), F.expr(
        f"flatten(transform(blocks, t -> transform(sequence(t.b * step + 1, {last}), i -> t.pre ^ t.post "
        f"^ aggregate(slice(f0, t.b * step + 1, i - 1 - t.b * step), {xor}) "
        f"^ aggregate(slice(f1, i + 1, {last} - i), {xor}))))").alias("keys"))


def _variants() -> Column:
    """A line's variants as hashed keys (k1 under k2): role 0 with its word i replaced (k2 = i), role 1
    the line itself as the shorter one, role 2 with its word i taken out (k2 = minus the words left)."""
    half, low, none = "cast(n div 2 as int)", "cast((n - 1) div 2 as int)", "cast(array() as array<int>)"
    replaced = (f"concat(if(sides & 1 <> 0, sequence({half} + 1, n), {none}), "
                f"if(sides & 2 <> 0, sequence(1, {half}), {none}))")
    taken = (f"array_distinct(concat(if(sides & 4 <> 0, sequence({low} + 1, n), {none}), "
             f"if(sides & 8 <> 0, sequence(1, {low} + 1), {none})))")
    own = "array(struct(whole as k1, -n as k2, 1 as role))"
    return F.expr(f"concat(transform({replaced}, i -> struct(keys[i - 1] as k1, i as k2, 0 as role)), "
                  f"transform({taken}, i -> struct(keys[i - 1] as k1, 1 - n as k2, 2 as role)), "
                  f"if(sides & 1 <> 0 or sides & 2 <> 0, {own}, slice({own}, 1, 0)))")


def _one_edit(a: str, b: str) -> str:
    """SQL: two word arrays are at most one word edit apart."""
    same = f"coalesce(array_position(zip_with(slice({a}, 1, least(size({a}), size({b}))), " \
           f"slice({b}, 1, least(size({a}), size({b}))), (x, y) -> x = y), false), 0)"
    # p: the first differing position, or one past the shorter line
    p = f"cast(if({same} = 0, least(size({a}), size({b})) + 1, {same}) as int)"
    tail_a = f"slice({a}, {p} + if(size({a}) >= size({b}), 1, 0), size({a}))"
    tail_b = f"slice({b}, {p} + if(size({b}) >= size({a}), 1, 0), size({b}))"
    return f"abs(size({a}) - size({b})) <= 1 and {tail_a} = {tail_b}"


def near_earlier_lines(lines: DataFrame, hashed: DataFrame) -> DataFrame:
    """First occurrences ``(__id, __th, __no)`` of distinct lines that have an earlier one-edit line."""
    places = _candidates(hashed)
    cand = cut_lineage(_with_words(places, lines))
    var = cut_lineage(_with_variant_keys(cand).select("c", F.explode_outer(_variants()).alias("v")).select("c", "v.*"))
    first = (var.groupBy("k1", "k2").agg(F.min(F.when(F.col("role") < 2, F.col("c"))).alias("a"),
                                         F.min(F.when(F.col("role") == 2, F.col("c"))).alias("z"),
                                         F.min("c").alias("lo"), F.max("c").alias("hi"))
             .where("lo <> hi").drop("lo", "hi"))
    # Replaced word: all of a key are partners. Put in or taken out: only a shorter and a longer line.
    early = F.when(F.col("role") == 1, F.col("z")).otherwise(F.col("a"))
    pairs = cut_lineage(var.join(first, ["k1", "k2"]).withColumn("e", early).where("e < c").select("c", "e").distinct())
    words = cand.select("c", "w")
    ok = (pairs.join(words.withColumnRenamed("w", "wc"), "c").join(words.toDF("e", "we"), "e")
          .where(F.expr(_one_edit("wc", "we"))).select("c").distinct())
    return places.join(ok, "c", "left_semi").select(_ID, _TH, _NO)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 5,
                n_lines_col: str | None = None, n_dropped_col: str | None = None) -> DataFrame:
    """``docs`` with the duplicate lines taken out of ``text_col``; optionally with the number of
    lines that each document had and lost."""
    given = docs.columns                                        # worked on by place, whatever the names
    docs = docs.toDF(*[f"c{k}" for k in range(len(given))])
    id_col, text_col = f"c{given.index(id_col)}", f"c{given.index(text_col)}"
    lines = _lines(docs, id_col, text_col)
    # Hashes without words, once for all that need no words: a fraction of the text.
    hashed = cut_lineage(_hashed(lines, min_words))
    first = (hashed.groupBy("h1", "h2").agg(F.min(F.struct(_ID, _TH, _NO)).alias("at"), F.first("n").alias("n"))
             .where("n > 0").select("at.*"))
    near = near_earlier_lines(lines, hashed)
    kept = first.alias("k").join(near.alias("o"), _same_place("k", "o"), "left_anti")
    kept = (kept.groupBy(F.col(_ID).alias("__kid"), F.col(_TH).alias("__kth"))
            .agg(F.collect_list(_NO).alias("__kept")).hint("shuffle_hash"))
    out = docs.withColumn("__th", F.xxhash64(text_col)).join(
        kept, F.col(id_col).eqNullSafe(F.col("__kid")) & (F.col("__th") == F.col("__kth")), "left")
    out = out.withColumn("__lines", F.split(text_col, "\n"))
    # Blank lines stay: nothing in them but white space (any other first character settles it).
    blank = F.transform("__lines", lambda x, i: F.when((x < "!") & ~x.rlike(r"[^\x20\x09-\x0D]"), i))
    out = out.withColumn("__stay", F.sort_array(F.concat(
        F.coalesce("__kept", F.array().cast("array<int>")), F.array_compact(blank))))
    stays = F.array_join(F.transform("__stay", lambda i: F.get("__lines", i)), "\n")
    extra = {}
    if n_lines_col:
        extra[n_lines_col] = F.coalesce(F.size("__lines"), F.lit(0)).cast("long")
    if n_dropped_col:
        extra[n_dropped_col] = F.when(F.col(text_col).isNull(), 0).otherwise(
            F.size("__lines") - F.size("__stay")).cast("long")
    cols = [stays.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    return out.select(*cols, *[v.alias(f"x{k}") for k, v in enumerate(extra.values())]).toDF(*given, *extra)
