"""SQL access to the review tables through registered views.

``register_review_views`` exposes processed reviews as ``raw_reviews`` (with
``review_date``) and the sentiment table as ``review_sentiments``, so users
who query these tables in SQL can run their statements with ``spark.sql``.
Spark does not sum booleans: count a flag with ``count_if(spam_flag)``.
The summaries themselves are the DataFrame operators in
``veracity.operators`` (``summaries`` below runs them on the views).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.operators import products as pr
from veracity.operators import reviewers as rv
from veracity.operators.signals import lexicon_signals


def register_review_views(processed: DataFrame, min_body_length: int | None = 10,
                          preset: str = "hql") -> DataFrame:
    """Register ``raw_reviews`` and ``review_sentiments`` temp views; returns the sentiment table."""
    processed.withColumnRenamed("date", "review_date").createOrReplaceTempView("raw_reviews")
    p = processed
    if "score_tenths" not in p.columns:
        p = p.withColumn("score_tenths", F.round(F.col("reviewer_fraud_score") * 10).cast("int"))
    sent = pr.review_sentiments(lexicon_signals(p, preset), min_body_length=min_body_length, preset=preset)
    sent.createOrReplaceTempView("review_sentiments")
    return sent


def summaries(spark: SparkSession) -> dict[str, DataFrame]:
    """The three SQL-form summaries computed from the registered sentiment view."""
    sent = spark.table("review_sentiments")
    return {"suspicious_reviewers": rv.suspicious_reviewers(sent, min_reviews=4),
            "product_fraud_summary": pr.product_fraud_summary(sent, with_stddev=True),
            "daily_review_bursts": pr.daily_review_bursts(sent, min_count=11, day="raw")}
