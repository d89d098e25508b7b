"""No operator or job loses, merges or multiplies rows: odd JSON values, long or missing ids, null times."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from veracity.ml import features as mf
from veracity.operators.normalise import FIELD_CAPS, normalise_reviews, unparsed_dates
from veracity.operators.products import daily_review_bursts, hourly_bursts
from veracity.operators.reviewers import fraud_scores
from veracity.plans import jobs
from veracity.sources.fixture import reviews_from_tables
from veracity.sources.readers import RAW_REVIEW, read_broken_lines, read_review_lines


def test_json_values_of_other_types_are_kept(spark, tmp_dir):
    lines = [{"review_id": "a", "rating": "5.0", "helpful_votes": 3.0, "verified_purchase": "true"},
             {"review_id": "b", "rating": 4, "helpful_votes": "3", "verified_purchase": False},
             {"review_id": 7, "rating": "many", "helpful_votes": 2}, {"review_id": "d", "body": "x\ny"}]
    path = os.path.join(tmp_dir, "r.json")
    with open(path, "w") as f:
        f.write("\n".join(map(json.dumps, lines)) + "\n\n{broken\n[1]\n")
    df = read_review_lines(spark, path, RAW_REVIEW)
    got = {r.review_id: (r.rating, r.helpful_votes, r.verified_purchase) for r in df.collect()}
    want = {"a": (5.0, 3, True), "b": (4.0, 3, False), "7": (None, 2, None), "d": (None, None, None)}
    assert {k: v for k, v in got.items() if k} == want
    assert df.where("review_id is not null").count() == 4
    assert "{broken" in {r.line for r in read_broken_lines(spark, path, RAW_REVIEW).collect()}


def test_long_ids_stay_apart_and_content_ids(spark):
    rows = [("good", "4", "u" * 25 + x, "B" * 25 + x, "t" * 150) for x in "XY"]
    df = spark.createDataFrame(rows, "text string, rating string, reviewer string, asin string, title string")
    out = normalise_reviews(df)
    assert out.select("reviewer_id").distinct().count() == out.select("product_asin").distinct().count() == 2
    assert {len(r.title) for r in out.collect()} == {150}
    assert {len(r.title) for r in normalise_reviews(df, caps=FIELD_CAPS).collect()} == {100}
    ids = sorted(r.review_id for r in out.collect())
    assert ids == sorted(r.review_id for r in normalise_reviews(df.repartition(5)).collect()) and len(set(ids)) == 2
    other = normalise_reviews(df.withColumn("text", F.lit("bad")))
    assert not {r.review_id for r in other.collect()} & set(ids)


@pytest.mark.parametrize("text", ["Jan 5, 2024", "2024/01/05", "5 January 2024", "5 Jan 2024", "2024-01-05 10:30",
                                  "January 5, 2024", "2024-01-05T10:30:00.123"])
def test_date_layouts(spark, text):
    df = spark.createDataFrame([("ok", "3", text), ("ok", "3", "some day")], "text string, rating string, date string")
    got = {r.date for r in normalise_reviews(df).collect()}
    assert "Reviewed in the United States on January 05, 2024" in got
    assert tuple(unparsed_dates(df).first()) == (2, 1)


def test_reviews_without_a_time_are_a_group(spark):
    rows = [("P", None, 4.0, 0.9)] * 6 + [("P", "2024-01-05 10:59:59", 2.0, 0.1)] * 5 + [(None, "2024-01-05 11:00:00", 2.0, None)]
    df = spark.createDataFrame(rows, "product_asin string, t string, rating double, fake_probability double")
    df = df.withColumn("scraped_at", F.col("t").cast("timestamp_ntz"))
    got = {(r.product_asin, r.hour): (r.review_count, r.fake_count) for r in hourly_bursts(df).collect()}
    assert got == {("P", None): (6, 6), ("P", "2024-01-05-10"): (5, 0)}


def test_daily_bursts_order_is_total(spark):
    rows = [("P", d, 5.0, False) for d in ("b", "a", "c") for _ in range(3)]
    df = spark.createDataFrame(rows, "product_asin string, review_date string, rating double, spam_flag boolean")
    assert [r.review_date for r in daily_review_bursts(df, min_count=3).collect()] == ["a", "b", "c"]


def test_stored_label_wins(spark):
    p = fraud_scores(reviews_from_tables(spark, SF_SMALL).limit(50)).withColumn(
        "is_fake_ground_truth", F.when(F.col("review_id").endswith("1"), 1).when(F.col("review_id").endswith("2"), 0))
    rules = {r.review_id: r.label for r in mf.feature_table(p.drop("is_fake_ground_truth")).collect()}
    for r in mf.feature_table(p).collect():
        assert r.label == {"1": 1, "2": 0}.get(r.review_id[-1], rules[r.review_id])


def test_building_the_flagship_runs_no_job(spark):
    reviews = reviews_from_tables(spark, SF_SMALL)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "building")
    fraud_scores(reviews)
    jobs_run = tracker.getJobIdsForGroup("plan-only")
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs_run) == 0


@pytest.mark.parametrize("trainer", ["local", "cluster"])
def test_predict_keeps_rows(spark, tmp_dir, trainer):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import DecisionTreeClassifier
    raw, processed = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "processed")
    r = reviews_from_tables(spark, SF_SMALL).drop("fake_probability").limit(120)
    r = r.withColumn("scraped_at", F.col("scraped_at").cast("string"))
    r = r.unionByName(r).withColumn("review_id", F.when(F.pmod(F.xxhash64("review_id"), F.lit(4)) > 0, F.col("review_id")))
    r.write.json(raw)
    out = jobs.score_job(spark, raw, processed)
    assert out.count() == 240
    p = out if trainer == "cluster" else None
    df = mf.proxy_labels(p) if trainer == "cluster" else mf.feature_table(out)
    df = df.withColumn("label", F.pmod(F.xxhash64("body"), F.lit(2)).cast("double"))
    pipe = mf.hashed_text_pipeline(50, 1) if trainer == "cluster" else mf.vocab_text_pipeline(20, 1)
    clf = DecisionTreeClassifier(featuresCol="features", labelCol="label", maxDepth=2)
    model, target = os.path.join(tmp_dir, "model"), os.path.join(tmp_dir, "scored")
    Pipeline(stages=pipe.getStages() + [clf]).fit(df).write().overwrite().save(model)
    jobs.predict_job(spark, model, processed, target, trainer=trainer)
    scored = spark.read.parquet(target)
    assert scored.count() == 240
    assert scored.where("product_asin is null or scraped_at is null").count() == 0
