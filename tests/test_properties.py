"""Invariants over whole tables."""

from pyspark.sql import functions as F

from conftest import SF_MID
from veracity.operators.reports import overall_summary
from veracity.operators.reviewers import fraud_scores
from veracity.plans.registry import normalised, reviews
from veracity.session import cluster_conf


def test_normalised_ratings_in_range(spark):
    n = normalised(spark, SF_MID)
    row = n.agg(F.min("rating"), F.max("rating"), F.count_if(F.col("review_id").isNull())).first()
    assert 1.0 <= row[0] and row[1] <= 5.0 and row[2] == 0


def test_scores_and_totals(spark):
    p = fraud_scores(reviews(spark, SF_MID))
    bad = p.filter((F.col("score_tenths") < 0) | (F.col("score_tenths") > 10)
                   | (F.col("reviewer_fraud_score") * 10 != F.col("score_tenths"))).count()
    assert bad == 0
    s = overall_summary(p).first()
    assert s.fake_reviews + s.genuine_reviews == s.total_reviews == p.count()


def test_cluster_conf_scales_with_input():
    small = cluster_conf(10 * 2**30, 1000)
    big = cluster_conf(100 * 2**40, 1000)
    assert int(small["spark.sql.shuffle.partitions"]) == 3000
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
