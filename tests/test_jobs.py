"""End-to-end jobs on files derived from the smallest driver tables."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from veracity.plans import jobs
from veracity.sources.fixture import reviews_from_tables


def test_score_summaries_snapshot(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    reviews_from_tables(spark, SF_SMALL).drop("fake_probability") \
        .withColumn("scraped_at", F.col("scraped_at").cast("string")).write.json(raw)
    processed = os.path.join(tmp_dir, "processed")
    out = jobs.score_job(spark, raw, processed)
    assert out.count() == 1000
    assert out.filter(F.col("reviewer_flags.total_reviews").isNull()).count() == 0
    tables = jobs.summaries_job(spark, processed, os.path.join(tmp_dir, "summ"), preset="word")
    assert tables["product_fraud_summary"].agg(F.sum("total_reviews")).first()[0] == 1000
    assert os.path.isdir(os.path.join(tmp_dir, "summ", "daily_review_bursts_csv"))
    scored = os.path.join(tmp_dir, "scored")
    reviews_from_tables(spark, SF_SMALL).write.parquet(scored)
    jobs.snapshot_job(spark, scored, os.path.join(tmp_dir, "snap"))
    jobs.snapshot_job(spark, scored, os.path.join(tmp_dir, "snap"))
    snaps = spark.read.parquet(os.path.join(tmp_dir, "snap"))
    assert snaps.select("generated_at").distinct().count() == 2


# FIXED VALUES: header lines of the three summary exports of the local run.
LOCAL_HEADERS = {
    "suspicious_reviewers": "reviewer_id,review_count,avg_rating,spam_count,avg_fraud_score,mismatch_count",
    "product_fraud_summary": ("product_asin,total_reviews,avg_rating,spam_reviews,avg_fraud_score,"
                              "sentiment_mismatches,spam_percentage"),
    "daily_review_bursts": "product_asin,date_clean,daily_count,daily_avg_rating,daily_spam_count",
}


def test_local_exports_have_the_original_headers(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    reviews_from_tables(spark, SF_SMALL).drop("fake_probability") \
        .withColumn("scraped_at", F.col("scraped_at").cast("string")).write.json(raw)
    processed = os.path.join(tmp_dir, "processed")
    jobs.score_job(spark, raw, processed)
    out = os.path.join(tmp_dir, "summ")
    jobs.summaries_job(spark, processed, out, preset="word")
    for name, header in LOCAL_HEADERS.items():
        d = os.path.join(out, name + "_csv")
        part = [f for f in os.listdir(d) if f.endswith(".csv")][0]
        with open(os.path.join(d, part)) as fh:
            assert fh.readline().strip() == header, name


def test_append_summary_rows(spark, tmp_dir):
    from veracity.operators.reviewers import fraud_scores
    from veracity.sources.sinks import append_summary
    p = fraud_scores(reviews_from_tables(spark, SF_SMALL))
    path = os.path.join(tmp_dir, "summary")
    append_summary(p, path)
    append_summary(p, path)
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 2 and all(r.total_reviews == 1000 for r in rows)
    assert rows[0].fake_reviews + rows[0].genuine_reviews == 1000
