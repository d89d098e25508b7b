"""Word search and counts against the patterns that define them."""

import re

from pyspark.sql import functions as F

from veracity.functions import lexicons as lx
from veracity.functions import text as tx

LISTS = [lx.SPAM_WORDS_LOADER, lx.POSITIVE_WORDS_LOADER, lx.NEGATIVE_WORDS_LOADER, lx.MISMATCH_WORDS_SQL]


def test_hits_are_those_of_the_patterns(spark):
    every = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    rows = [(c + "free" + c,) for c in every] + [(" so freE" + c,) for c in every]
    rows += [(w[:k] + c + w[k + 1:],) for w in ("HATE", "junk", "discount", "visit our") for k in range(len(w))
             for c in [*tx.ODD_LETTERS, "\u00c5", "\u00e9", w[k].upper()]]
    rows += [("",), (None,), ("freedom free",), ("unfree free_ FREE!",), ("gr\u00e9at Greatest \u0130",)]
    b = F.col("b")
    d = spark.createDataFrame(rows, "b string").repartition(8)
    for words in LISTS:
        word, sub = tx.lexicon_hit(b, words), tx.lexicon_hit(b, words, "substring")
        bad = d.where(~word.eqNullSafe(tx.matches(b, tx.bounded_pattern(words)))
                      | ~sub.eqNullSafe(tx.matches(b, tx.substring_pattern(words))))
        assert bad.count() == 0, bad.take(3)
    url = tx.matches(b, tx.bounded_pattern(lx.SPAM_PHRASES_SCORING + lx.SPAM_WORDS_SCORING)) | tx.matches(b, "(?i)" + lx.URL_PATTERN)
    odd = d.unionByName(spark.createDataFrame([("hTTpS://a",), ("http\u017f://",), ("http:/ /",)], "b string"))
    assert odd.where(~tx.spam_hit(b).eqNullSafe(url)).count() == 0
    # a pattern is no longer tried at every position of an ordinary text
    assert "contains" in str(tx.lexicon_hit(b, ["free"]))


def test_counts_are_those_of_the_patterns(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    rows = [f"a{c}b{c}{c}Cd{c}" for c in spaces] + [f"{c}x" for c in spaces] + ["", " ", "\u00c9 \U0001D400a Z", "ab"]
    rows += [" ".join(["w"] * n) for n in range(17)] + ["\u2003".join(["W"] * n) for n in range(17)]
    b = F.col("b")
    d = spark.createDataFrame([(r,) for r in rows] + [(None,)], "b string")
    out = d.select("b", tx.word_count(b).alias("n"), tx.uppercase_count(b).alias("u"),
                   F.regexp_count(b, F.lit(r"\p{IsUppercase}")).alias("old_u"),
                   *[tx.fewer_words(b, k).alias(f"f{k}") for k in (5, 8, 15)]).collect()
    for r in out:
        assert r.u == r.old_u
        n = None if r.b is None else len(r.b.split())
        assert r.n == n and [r.f5, r.f8, r.f15] == [None if n is None else n < k for k in (5, 8, 15)], r
    assert re.search(r"\\A", str(tx.fewer_words(b, 5)))


def test_few_words_are_told_from_the_first_characters(spark):
    b = F.col("b")
    rows = ["word " * 40, "x" * 400 + " a b c d e", " " * 300 + "a b c d e", "x" * 119 + " " + "y" * 9, "é! 🙂! " * 30, "!", None]
    d = spark.createDataFrame([(r,) for r in rows], "b string")
    for r in d.select("b", tx.exclamation_count(b).alias("x"), *[tx.fewer_words(b, k).alias(f"f{k}") for k in (1, 5, 8)]).collect():
        n = None if r.b is None else len(r.b.split())
        assert [r.f1, r.f5, r.f8] == [None if n is None else n < k for k in (1, 5, 8)]
        assert r.x == (None if r.b is None else r.b.count("!"))
    assert "substr" in str(tx.fewer_words(b, 5))
