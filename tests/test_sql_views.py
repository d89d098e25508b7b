"""Registered views answer SQL consistently with the DataFrame operators."""

from conftest import SF_MID
from veracity.operators.reviewers import fraud_scores
from veracity.plans.sql_views import register_review_views, summaries
from veracity.sources.fixture import reviews_from_tables


def test_views_and_operators_agree(spark):
    sent = register_review_views(fraud_scores(reviews_from_tables(spark, SF_MID)))
    assert spark.sql("SELECT count(*) FROM raw_reviews").first()[0] == 10000
    # A user's own statement over the view: spam share per product, in percent.
    q = spark.sql("""
        SELECT product_asin, count_if(spam_flag) AS spam, count(*) AS n
        FROM review_sentiments GROUP BY product_asin""").collect()
    got = {r.product_asin: (r.spam, r.n) for r in q}
    ops = summaries(spark)["product_fraud_summary"].collect()
    assert {r.product_asin: (r.spam_reviews, r.total_reviews) for r in ops} == got
    assert sent.count() == sum(n for _, n in got.values())
    assert summaries(spark)["suspicious_reviewers"].count() > 0
