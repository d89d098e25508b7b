"""Per-review signals: spam flags, text statistics, sentiment, weak labels.

All operators are narrow projections (no shuffle): they add columns to each
row with built-in expressions and keep every input column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.functions import lexicons as lx
from veracity.functions import measures
from veracity.functions import text as tx
from veracity.functions.measures import ready


def with_review_defaults(df: DataFrame, clean_keys: bool = False) -> DataFrame:
    """Missing or NULL fields take the scoring job's defaults.

    body '', rating 3.0, reviewer 'UNKNOWN', helpful votes 0, not verified.
    A NULL is treated like an absent key (the original crashed on it).
    ``clean_keys`` declares that ``reviewer_id`` has no NULLs (defaults were
    applied when the table was written); it is then passed through untouched,
    so a table bucketed on it keeps its partitioning.
    """
    defaults = {"body": F.lit(""), "rating": F.lit(3.0), "reviewer_id": F.lit(lx.UNKNOWN_ID),
                "helpful_votes": F.lit(0), "verified_purchase": F.lit(False)}
    if clean_keys and "reviewer_id" in df.columns:
        defaults.pop("reviewer_id")
    out = df
    for name, value in defaults.items():
        if name in df.columns:
            out = out.withColumn(name, F.coalesce(F.col(name), value))
        else:
            out = out.withColumn(name, value)
    return out


def review_signals(df: DataFrame, spam: str = "scoring", min_len: int = 20,
                   short_len: int = 50, clean_keys: bool = False) -> DataFrame:
    """Adds spam_flag, word_count, has_url, exclamation_count, caps_ratio.

    ``spam_flag`` is true for a body shorter than ``min_len``, a spam-text hit,
    or a 1- or 5-star rating with no helpful votes and a body shorter than
    ``short_len``.
    """
    d = with_review_defaults(df, clean_keys=clean_keys)
    body = F.col("body")
    length = tx.char_length(body)
    extreme = F.col("rating").isin(*lx.EXTREME_RATINGS)
    spam_hit = ready(d, f"spam_{spam}", lambda: tx.spam_hit(body, spam))
    upper = ready(d, "uppercase_count", lambda: tx.uppercase_count(body))
    spam_flag = ((length < min_len) | spam_hit
                 | (extreme & (F.col("helpful_votes") == 0) & (length < short_len)))
    return d.select(
        "*",
        spam_flag.alias("spam_flag"),
        ready(d, "word_count", lambda: tx.word_count(body)).alias("word_count"),
        ready(d, "has_url", lambda: tx.has_url(body)).alias("has_url"),
        ready(d, "exclamation_count", lambda: tx.exclamation_count(body)).alias("exclamation_count"),
        tx.caps_ratio(body, upper).alias("caps_ratio"),
    )


#: Measures of the text that the sentiment table reads where its input has them (``functions.measures``).
SENTIMENT_MEASURES = ["word_count", "spam_scoring", "positive_hql", "negative_hql", "mismatch_hql"]

LEXICON_PRESETS = {
    # (positive words, negative words, mismatch words, form)
    "word": (lx.POSITIVE_WORDS, lx.NEGATIVE_WORDS, lx.NEGATIVE_WORDS, "word"),
    "hql": (lx.POSITIVE_WORDS, lx.NEGATIVE_WORDS, lx.MISMATCH_WORDS_SQL, "substring"),
}


def lexicon_signals(df: DataFrame, preset: str = "word") -> DataFrame:
    """Adds positive_signal, negative_signal, rating_sentiment_mismatch (0/1 ints).

    ``word``: word-bounded lists (the local scripts); ``hql``: substring
    match, and the mismatch list without "scam" (the SQL summary).
    """
    pos, neg, mis, form = LEXICON_PRESETS[preset]
    body = F.coalesce(F.col("body"), F.lit(""))
    rating = F.coalesce(F.col("rating"), F.lit(3.0))
    names = {"word": ("positive_word", "negative_word", "negative_word"), "hql": SENTIMENT_MEASURES[2:]}[preset]
    pos, neg, mis = (ready(df, n, lambda: tx.lexicon_hit(body, words, form)) for n, words in zip(names, (pos, neg, mis)))
    return df.select(
        "*",
        pos.cast("int").alias("positive_signal"),
        neg.cast("int").alias("negative_signal"),
        ((rating >= 4.0) & mis).cast("int")
        .alias("rating_sentiment_mismatch"),
    )


def _counted_points(body, rating, df: DataFrame | None = None):
    """Integer points of the rules that count characters and words (a Column), from the measures that ``df`` has."""
    def fewer_words(n):
        return tx.fewer_words(body, n) if df is None else ready(df, "word_count", lambda: tx.word_count(body)) < n
    exclamations, upper = tx.exclamation_count(body), tx.uppercase_count(body)
    if df is not None:
        exclamations, upper = ready(df, "exclamation_count", lambda: exclamations), ready(df, "uppercase_count", lambda: upper)
    rules = [
        (fewer_words(5) & rating.isin(*lx.EXTREME_RATINGS), lx.LABEL_POINTS_SHORT_EXTREME),
        (exclamations > 4, lx.LABEL_POINTS_EXCLAMATIONS),
        # caps ratio > 0.30, compared exactly as 10 * upper > 3 * max(len, 1)
        (upper * 10 > F.greatest(F.length(body), F.lit(1)) * 3,
         lx.LABEL_POINTS_CAPS),
        ((rating == 5.0) & fewer_words(8), lx.LABEL_POINTS_GENERIC_FIVE),
        # Cheap test first: AND short-circuits, so the counting regex only runs on short texts.
        (fewer_words(15) & (tx.lexicon_count(body, lx.POSITIVE_WORDS_LOADER) >= 3),
         lx.LABEL_POINTS_PRAISE_ONLY),
    ]
    return sum((F.when(cond, F.lit(pts)).otherwise(F.lit(0)) for cond, pts in rules), F.lit(0))


def _body_and_rating(body_col: str, rating_col: str):
    return F.coalesce(F.col(body_col), F.lit("")), F.coalesce(F.col(rating_col).cast("double"), F.lit(3.0))


def label_points(body_col: str = "body", rating_col: str = "rating", df: DataFrame | None = None):
    """Integer points of the seven weak-label rules (a Column), for a ``df`` with measures of the text from these."""
    body, rating = _body_and_rating(body_col, rating_col)
    df = df if df is not None and measures.MEASURE + "word_count" in df.columns else None
    negative, spam = tx.lexicon_hit(body, lx.NEGATIVE_WORDS_LOADER), tx.spam_hit(body, "loader")
    if df is not None:
        negative, spam = ready(df, "negative_loader", lambda: negative), ready(df, "spam_loader", lambda: spam)
    mismatch = (rating >= 4.0) & negative
    return (_counted_points(body, rating, df)
            + F.when(spam, F.lit(lx.LABEL_POINTS_SPAM)).otherwise(F.lit(0))
            + F.when(mismatch, F.lit(lx.LABEL_POINTS_MISMATCH)).otherwise(F.lit(0)))


def fake_label(body_col: str = "body", rating_col: str = "rating"):
    """1 where ``label_points`` reach the threshold, else 0 (a Column), for those who need no points.

    The word lists are searched only in texts where they can still decide, in one lower-cased copy. The
    one-element arrays bind a value that later conditions read, so that it is made once and only if needed.
    """
    body, rating = _body_and_rating(body_col, rating_col)
    spam, mismatch, least = lx.LABEL_POINTS_SPAM, lx.LABEL_POINTS_MISMATCH, lx.LABEL_THRESHOLD
    high = rating >= 4.0

    def by_words(points, low):
        is_spam = tx.lexicon_hit(body, lx.SPAM_WORDS_LOADER, low=low)
        is_mismatch = high & tx.lexicon_hit(body, lx.NEGATIVE_WORDS_LOADER, low=low)
        return (F.when(is_mismatch, (points + mismatch >= least) | ((points + mismatch + spam >= least) & is_spam))
                .otherwise((points + spam >= least) & is_spam))

    def by_points(points):
        most = points + F.when(high, F.lit(spam + mismatch)).otherwise(F.lit(spam))
        return (F.when(points >= least, F.lit(True)).when(most < least, F.lit(False))
                .otherwise(F.exists(F.array(F.lower(body)), lambda low: by_words(points, low))))
    return F.exists(F.array(_counted_points(body, rating)), by_points).cast("int")


def weak_labels(df: DataFrame) -> DataFrame:
    """Adds label_points and is_fake_ground_truth (1 when points >= 50)."""
    pts = label_points()
    return (df.select("*", pts.alias("label_points"))
            .withColumn("is_fake_ground_truth",
                        (F.col("label_points") >= lx.LABEL_THRESHOLD).cast("int")))
