"""On a review table bucketed by reviewer, the flagship plan has no shuffle."""

import os
import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from veracity.operators.reviewers import fraud_scores
from veracity.operators.signals import with_review_defaults
from veracity.sources.fixture import reviews_from_tables
from veracity.sources.sinks import save_bucketed


def test_bucketed_reviews_need_no_shuffle(spark, tmp_dir):
    src = with_review_defaults(reviews_from_tables(spark, SF_SMALL))
    save_bucketed(src, "reviews_by_reviewer_test", buckets=4, path=os.path.join(tmp_dir, "b"))
    t = spark.table("reviews_by_reviewer_test")
    scored = fraud_scores(t, clean_keys=True)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 0, plan
    base = fraud_scores(reviews_from_tables(spark, SF_SMALL)).select("review_id", "reviewer_fraud_score")
    got = scored.select("review_id", "reviewer_fraud_score")
    assert got.exceptAll(base).count() == 0 and base.exceptAll(got).count() == 0
    spark.sql("DROP TABLE reviews_by_reviewer_test")
