"""Product- and time-level operators: the sentiment table and its summaries,
hourly bursts and rating deviation.

All are hash aggregations with map-side partial aggregation, so a product
holding a third of the reviews costs one partial row per map task, not one
task holding its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.functions import dates as dt
from veracity.functions import lexicons as lx
from veracity.functions.numeric import mean6, ratio6, round6, scaled_round
from veracity.operators.signals import lexicon_signals

SENTIMENT_COLUMNS = ["review_id", "product_asin", "reviewer_id", "rating", "body", "word_count",
                     "spam_flag", "reviewer_fraud_score", "positive_signal", "negative_signal",
                     "rating_sentiment_mismatch", "review_date"]


def review_sentiments(processed: DataFrame, min_body_length: int | None = 10,
                      preset: str = "hql") -> DataFrame:
    """The sentiment table over processed reviews.

    Projection + sentiment signals (``hql``: substring lists; ``word``:
    word-bounded) + ``LENGTH(body) > min_body_length`` (None: keep all rows).
    ``review_date`` is the review's date text. ``score_tenths`` is kept for
    exact averaging downstream.
    """
    df = processed
    if min_body_length is not None:
        df = df.filter(F.col("body").isNotNull() & (F.length("body") > min_body_length))
    df = df.withColumn("product_asin", F.coalesce(F.col("product_asin"), F.lit(lx.UNKNOWN_ID)))
    have = {"positive_signal", "negative_signal", "rating_sentiment_mismatch"} <= set(df.columns)
    # Signals computed upstream (before the reviewer join, see plans.jobs) are reused.
    s = df if have else lexicon_signals(df, preset=preset)
    return s.select(*[c for c in SENTIMENT_COLUMNS if c != "review_date"],
                    F.col("date").alias("review_date"), "score_tenths")


def product_fraud_summary(sentiments: DataFrame, with_stddev: bool = True) -> DataFrame:
    """Per product: counts, mean rating, spam share (half-up 2 dp), mismatches, mean score.

    ``with_stddev`` (the SQL form) adds the population std of ratings and
    names the score mean ``avg_fraud_exposure``; the local form names it
    ``avg_fraud_score``. Ordered by spam_percentage desc, product_asin.
    """
    n = F.count(F.lit(1))
    aggs = [n.alias("total_reviews"),
            mean6(F.col("rating")).alias("avg_rating")]
    if with_stddev:
        aggs.append(round6(F.stddev_pop("rating")).alias("rating_stddev"))
    spam = F.count_if(F.col("spam_flag"))
    aggs += [spam.alias("spam_reviews"),
             scaled_round(spam * 100, n, 2, half_even=False).alias("spam_percentage"),
             F.sum("rating_sentiment_mismatch").alias("sentiment_mismatches"),
             ratio6(F.sum("score_tenths"), n * 10)
             .alias("avg_fraud_exposure" if with_stddev else "avg_fraud_score")]
    out = sentiments.groupBy("product_asin").agg(*aggs)
    if not with_stddev:
        # The local form lists the share last.
        out = out.select("product_asin", "total_reviews", "avg_rating", "spam_reviews", "avg_fraud_score",
                         "sentiment_mismatches", "spam_percentage")
    return out.orderBy(F.col("spam_percentage").desc(), "product_asin")


def daily_review_bursts(sentiments: DataFrame, min_count: int = 11, day: str = "raw") -> DataFrame:
    """Product-days with at least ``min_count`` reviews.

    ``day='raw'`` groups on the date text (``review_date``, the SQL form;
    ``> 10`` is ``min_count=11``); ``day='clean'`` on the text after ' on ',
    or 'Unknown' (``date_clean``, the local form, used with ``min_count=3``).
    """
    if day == "raw":
        key = F.col("review_date").alias("review_date")
    elif day == "clean":
        key = dt.review_day_text(F.col("review_date")).alias("date_clean")
    else:
        raise ValueError(f"unknown day form {day!r}")
    return (sentiments.groupBy("product_asin", key).agg(
        F.count(F.lit(1)).alias("daily_count"),
        mean6(F.col("rating")).alias("daily_avg_rating"),
        F.count_if(F.col("spam_flag")).alias("daily_spam_count"))
        .filter(F.col("daily_count") >= min_count)
        .orderBy(F.col("daily_count").desc(), "product_asin", F.col("review_date" if day == "raw" else "date_clean")))


def hourly_bursts(scored: DataFrame, window_hours: int = 1, threshold: int = 5,
                  score_col: str = "fake_probability", fake_at: float = 0.5) -> DataFrame:
    """Product x time-bucket review counts of at least ``threshold``.

    Buckets are tumbling windows of ``window_hours`` hours over ``scraped_at``
    (1 hour: the calendar hour), labelled 'yyyy-MM-dd-HH' by their start.
    """
    # Buckets of the naive event time, so they do not depend on the session time
    # zone; reviews without a time are a bucket of their own (a window would drop them).
    hours = F.expr("floor(timestampdiff(MINUTE, TIMESTAMP_NTZ'1970-01-01 00:00:00', "
                   "cast(scraped_at as timestamp_ntz)) / 60)")
    start = (F.floor(hours / int(window_hours)) * int(window_hours)).cast("int")
    bucket = F.timestamp_add("HOUR", start, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    fake = F.coalesce(F.col(score_col) >= fake_at, F.lit(False))
    g = (scored.select(F.coalesce(F.col("product_asin"), F.lit(lx.UNKNOWN_ID)).alias("product_asin"),
                       bucket.alias("bucket"), "rating", fake.alias("is_fake"))
         .groupBy("product_asin", "bucket").agg(
             F.count(F.lit(1)).alias("review_count"),
             mean6(F.col("rating")).alias("avg_rating"),
             F.count_if(F.col("is_fake")).alias("fake_count")))
    return (g.filter(F.col("review_count") >= threshold)
            .select("product_asin", F.date_format("bucket", "yyyy-MM-dd-HH").alias("hour"),
                    "review_count", "avg_rating", "fake_count")
            .orderBy(F.col("review_count").desc(), "product_asin", "hour"))


def rating_deviation(scored: DataFrame, by: str = "fake_probability", threshold: float = 0.5,
                     require_both: bool = True) -> DataFrame:
    """Per product: overall, genuine and fake mean ratings and the inflation.

    Fake: ``by >= threshold``; genuine: everything else (a missing score is
    genuine). With ``require_both`` only products having both classes are
    kept; otherwise an empty class has mean 0. Means and inflation are
    rounded half-even to 2 dp; ordered by |inflation| desc, product_asin.
    ``by`` may be ``score_tenths`` (threshold in tenths) for the report form.
    """
    fake = F.coalesce(F.col(by) >= threshold, F.lit(False))
    r = F.col("rating")
    g = (scored.withColumn("product_asin", F.coalesce(F.col("product_asin"), F.lit(lx.UNKNOWN_ID)))
         .groupBy("product_asin").agg(
             F.count(F.lit(1)).alias("total_reviews"),
             F.sum(r).alias("s_all"),
             F.count_if(fake).alias("fake_review_count"),
             F.coalesce(F.sum(F.when(fake, r)), F.lit(0.0)).alias("s_fake"),
             F.count_if(~fake).alias("genuine_review_count"),
             F.coalesce(F.sum(F.when(~fake, r)), F.lit(0.0)).alias("s_gen")))
    if require_both:
        g = g.filter((F.col("fake_review_count") > 0) & (F.col("genuine_review_count") > 0))
    nf = F.greatest(F.col("fake_review_count"), F.lit(1))
    ng = F.greatest(F.col("genuine_review_count"), F.lit(1))
    out = g.select(
        "product_asin", "total_reviews",
        scaled_round(F.col("s_all"), F.col("total_reviews"), 2).alias("overall_avg"),
        scaled_round(F.col("s_gen"), ng, 2).alias("genuine_avg"),
        scaled_round(F.col("s_fake"), nf, 2).alias("fake_avg"),
        scaled_round(F.col("s_fake") * ng - F.col("s_gen") * nf, nf * ng, 2).alias("rating_inflation"),
        "fake_review_count", "genuine_review_count")
    return out.orderBy(F.abs("rating_inflation").desc(), "product_asin")
