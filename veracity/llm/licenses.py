"""License scans: base phrases, and an exact set-similarity join of text blocks with notices.

Base: every place where a phrase's words stand one after the other. Method: a block of text (a
line, and the whole text whatever its line feeds, so that a notice over several lines is seen; what
has more than ``block_words`` words in windows that overlap by half: any ``block_words / 2 + 1`` words
lie in one window) matches a notice when it holds at least ``threshold`` percent of the notice's
distinct words. The notices' words are ordered by their
frequency over all documents, rarest first. A matching block holds one of a
notice's first ``n - ceil(t n) + 1`` words, so only these prefix words are joined with the blocks'
words. The length filter wants enough notice words in the block at all, the positional filter
enough of them from the joined word on, and the whole sets decide. Notices and phrases are fixed
lists; the join's small side is their prefix words, a few hundred rows at most. Notices that differ
in a word or two hold enough of each other's words, so a match also says whether its block names the
notice (``TELLING``). Every match is in ``notices`` and ``notice_score``; only named ones are labels.

How it runs: one pass counts the documents that hold each notice word (partial sums, a few hundred
rows); one pass makes the blocks of texts that hold a prefix word, joins and verifies them and
keeps the best per text; the results meet the documents by the 128-bit hash of the text, so copies
count once and only hashes and numbers are shuffled.

Defined cases: null or wordless text has no words, no places and no labels; rows that repeat or
share an id are judged each by their own text; an empty table gives no rows; the id column may have
any name. Score: 1 with a base place, else the largest share of a notice's words found in a matching
block that names it, else 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.llm.common import cut_lineage

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Opening words of common notices, and the labels that the method gives.
NOTICES = {
    "agpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero "
            "general public license as published by the free software foundation",
    "apache": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided "
           "that the following conditions are met",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc0": "the person who associated a work with this deed has dedicated the work to the public domain",
    "gpl": "this work is licensed under the gnu general public license version 3",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
           "hereby granted",
    "lgpl": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
            "general public license",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
           "documentation files",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0",
}
# What a block must say besides, where a notice's words are nearly another's too (SQL over
# ``held``, the block's notice words, and ``b``, its words after the one before the block, '' at the start).
_NEAR_CC = "exists(sequence(1, size(b) - 1), i -> b[i] = '{0}' and arrays_overlap(slice(b, greatest(i - 2, 1), least(i, 3)), array('cc', 'by')))"
_GENERAL = "exists(sequence(1, size(b) - 1), i -> b[i] = 'general' and {0} b[i - 1] in ({1}))"
TELLING = {
    "agpl": "array_contains(held, 'affero')",
    "apache": "array_contains(held, 'apache')",
    "cc-by-nc": "array_contains(held, 'nc') and " + _NEAR_CC.format("nc"),
    "cc-by-sa": "array_contains(held, 'sa') and " + _NEAR_CC.format("sa"),
    # "general public license" of its own, not only as the end of another's name.
    "gpl": f"""not array_contains(held, 'general') or {_GENERAL.format("not", "'affero', 'lesser', 'library'")}""",
    "lgpl": f"""array_contains(held, 'lesser') or array_contains(held, 'library') and {_GENERAL.format("", "'library'")}""",
}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of letters and digits, A-Z lower-cased; null has none."""
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(low, _GAP), "")


def _starts(words: str, phrase: str) -> str:
    """SQL: where the phrase's words stand, counted from 0."""
    p = phrase.split()
    same = " and ".join(f"{words}[i + {k}] = '{w}'" for k, w in enumerate(p))
    return (f"if(size({words}) >= {len(p)}, filter(sequence(0, size({words}) - {len(p)}), i -> {same}), "
            "cast(array() as array<int>))")


def _base_places(words: str) -> Column:
    return F.expr("array(" + ", ".join(
        f"struct('{label}' as label, {_starts(words, phrase)} as places)" for phrase, label in PHRASES.items()) + ")")


def _text_key(text: str) -> list[Column]:
    return [F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__k1"),
            F.xxhash64(F.lit(1), F.coalesce(F.col(text), F.lit(""))).alias("__k2")]


def notice_word_frequencies(texts: DataFrame, notices: dict[str, str] = NOTICES) -> dict[str, int]:
    """Number of rows of ``texts(text)`` that hold each word of the notices (absent: none)."""
    vocabulary = sorted({w for t in notices.values() for w in t.split()})
    held = F.array_intersect(words_of(F.col("text")), F.array(*map(F.lit, vocabulary)))
    rows = texts.select(F.explode_outer(held).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["w"]: r["n"] for r in rows if r["w"] is not None}          # at most one row a notice word


def matching_blocks(texts: DataFrame, notices: dict[str, str] = NOTICES, threshold: int = 80,
                    block_words: int = 64, telling: dict[str, str] = TELLING) -> DataFrame:
    """``(__k1, __k2, label, containment, named)``: for each distinct text of ``texts(text)`` the notices
    that one of its blocks matches, with the largest containment, and the largest (``named``) in a block
    that also names the notice by ``telling``; null where none does."""
    spark = texts.sparkSession
    df = notice_word_frequencies(texts, notices)
    vocabulary = sorted({w for t in notices.values() for w in t.split()}, key=lambda w: (df.get(w, 0), w))
    rank = {w: k for k, w in enumerate(vocabulary)}
    prefix = []
    for label, notice in notices.items():
        own = sorted(set(notice.split()), key=rank.get)                  # rarest first
        need = -(-threshold * len(own) // 100)
        prefix += [(w, label, p, len(own), need, own) for p, w in enumerate(own[:len(own) - need + 1]) if df.get(w)]
    small = F.broadcast(spark.createDataFrame(
        prefix, "token string, label string, place int, size int, need int, own array<string>"))
    tokens = sorted({x[0] for x in prefix})
    if not tokens:
        return texts.select(*_text_key("text"), F.lit("").alias("label"), F.lit(0.0).alias("containment"),
                            F.lit(0.0).alias("named")).limit(0)

    some = F.arrays_overlap(words_of(F.col("text")), F.array(*map(F.lit, tokens)))
    rows = texts.where(some).groupBy(*_text_key("text")).agg(F.first("text").alias("text"))
    pieces = F.split("text", "\n")
    pieces = F.when(F.size(pieces) > 1, F.array_append(pieces, F.col("text"))).otherwise(pieces)
    lines = rows.select("__k1", "__k2", F.posexplode_outer(pieces).alias("line", "t"))
    lines = lines.select("__k1", "__k2", "line", words_of(F.col("t")).alias("w"))
    half = block_words // 2
    begin = F.expr(f"if(size(w) <= {block_words}, array(1), sequence(1, size(w) - {half}, {half}))")
    lines = lines.select("__k1", "__k2", "line", "w", begin.alias("begin"))
    cut = F.expr(f"transform(begin, at -> concat(array(if(at > 1, w[at - 2], '')), slice(w, at, {block_words})))")
    blocks = lines.select("__k1", "__k2", "line", F.posexplode_outer(cut).alias("at", "b"))
    known = F.array(*map(F.lit, vocabulary))
    held = F.array_intersect(known, F.expr(f"slice(b, 2, {block_words})"))   # the block's notice words, rarest first
    blocks = blocks.select("__k1", "__k2", "line", "at", "b", held.alias("held")).where(F.size("held") > 0)
    untold = ", ".join(f"if({told}, null, '{label}')" for label, told in telling.items() if label in notices)
    blocks = blocks.select("__k1", "__k2", "line", "at", "held",
                           F.expr(f"array_compact(array({untold or 'cast(null as string)'}))").alias("untold"))
    pairs = (blocks.select("*", F.posexplode_outer(F.array_intersect("held", F.array(*map(F.lit, tokens)))).alias("o", "token"))
             .join(small, "token"))
    # Length: enough notice words in the block; positional: this word and the rarer ones of the notice
    # before it, or the block's words from it on, can still make up the number that is needed.
    left = F.size("held") - F.array_position("held", F.col("token")) + 1
    pairs = pairs.where((F.size("held") >= F.col("need")) & (F.least(left, F.col("size") - F.col("place"))
                                                             + F.least("place", "o") >= F.col("need")))
    named = ~F.array_contains("untold", F.col("label"))
    pairs = pairs.select("__k1", "__k2", "line", "at", "label", "held", "own", "need", "size", named.alias("named")).distinct()
    common = F.size(F.array_intersect("held", "own"))
    share = common / F.col("size")
    return (pairs.where(common >= F.col("need")).groupBy("__k1", "__k2", "label")
            .agg(F.max(share).alias("containment"), F.max(F.when(F.col("named"), share)).alias("named")))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 80,
                  block_words: int = 64) -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_words, n_base, first_word, last_word, base_labels,
    labels, score, notices`` (all that a block matches, named or not)``, notice_score`` (the largest
    containment of these, else 0)."""
    texts = docs.select(F.col(text_col).alias("text"))
    found = cut_lineage(matching_blocks(texts, threshold=threshold, block_words=block_words)
                        .groupBy("__k1", "__k2")
                        .agg(F.collect_set(F.when(F.col("named").isNotNull(), F.col("label"))).alias("found"),
                             F.max("named").alias("best"), F.collect_set("label").alias("near"),
                             F.max("containment").alias("nearest")))
    rows = docs.select(F.col(id_col).alias("__id"), words_of(F.col(text_col)).alias("w"), *_text_key(text_col))
    first_words = sorted({p.split()[0] for p in PHRASES})
    rows = rows.select("*", F.when(F.arrays_overlap("w", F.array(*map(F.lit, first_words))),
                                   F.filter(_base_places("w"), lambda x: F.size(x["places"]) > 0)).alias("base"))
    places = F.flatten(F.transform("base", lambda x: x["places"]))
    rows = rows.select(
        "__id", "__k1", "__k2", F.size("w").cast("long").alias("n_words"), places.alias("places"),
        F.coalesce(F.array_sort(F.array_distinct(F.transform("base", lambda x: x["label"]))),
                   F.array().cast("array<string>")).alias("own"))
    out = rows.join(found, ["__k1", "__k2"], "left")
    n_base = F.coalesce(F.size("places"), F.lit(0))
    n_base = F.when(F.col("places").isNull(), 0).otherwise(n_base)
    every = F.array_sort(F.array_union("own", F.coalesce("found", F.array().cast("array<string>"))))
    return out.select(
        F.col("__id").alias(id_col), "n_words", n_base.cast("long").alias("n_base"), F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"), F.array_join("own", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(n_base > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce(F.array_join(F.array_sort("near"), ","), F.lit("")).alias("notices"),
        F.coalesce("nearest", F.lit(0.0)).alias("notice_score"))
