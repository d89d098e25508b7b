"""Normalisation of a messy CSV-layout source."""

from pyspark.sql import functions as F

from veracity.operators.normalise import normalise_reviews, resolve_columns


def test_resolution_prefers_first_candidate():
    cols = resolve_columns(["text", "reviews.text", "stars", "id", "asin"])
    assert cols["text"] == "reviews.text" and cols["rating"] == "stars" and cols["product"] == "asin"
    assert cols["title"] is None


def test_cleaning_and_defaults(spark):
    rows = [("1", "  good product overall  ", "x", "2.7", "not a date", "u" * 30, "B1"),
            ("2", "fine", "0", "x", "2024-03-05 10:00:00", None, None),
            ("3", "ok", "7", None, None, "bob", "B2"),
            ("4", "nan", "3", "1", None, "bob", "B2"),
            ("5", "   ", "3", "1", None, "bob", "B2"),
            ("6", "kept", None, "1", None, "bob", "B2"),
            ("7", "\tTerrible! Worst!\n", "4.5", "0", "2024-03-05", "amy", "B3"),
            ("9", "no number", "NaN", "0", None, "amy", "B3"),
            ("8", "Great!", "5", "0", None, "amy", "B3")]
    df = spark.createDataFrame(rows, "`row` string, `reviews.text` string, `reviews.rating` string, "
                                     "`reviews.numHelpful` string, `reviews.date` string, "
                                     "`reviews.username` string, `asins` string")
    out = {r.body: r for r in normalise_reviews(df, key_col="row", scraped_at=F.lit(None).cast("timestamp")).collect()}
    assert set(out) == {"good product overall", "fine", "ok", "Terrible! Worst!", "Great!"}
    a = out["good product overall"]
    assert (a.rating, a.helpful_votes, a.verified_purchase) == (3.0, 2, True)
    assert a.date == "Reviewed in the United States on January 01, 2024"
    assert a.reviewer_id == "u" * 30 and a.reviewer_name == "u" * 30
    b = out["fine"]
    assert (b.rating, b.helpful_votes, b.reviewer_id, b.reviewer_name, b.product_asin) == \
        (1.0, 0, "UNKNOWN", "Anonymous", "UNKNOWN")
    assert b.date == "Reviewed in the United States on March 05, 2024"
    assert out["ok"].rating == 5.0
    t = out["Terrible! Worst!"]
    # 4.5 is not an extreme rating: only the mismatch rule (35 points) fires
    assert t.is_fake_ground_truth == 0 and t.rating == 4.5
    # short + extreme (35) and generic five-star (15) reach the threshold of 50
    assert out["Great!"].is_fake_ground_truth == 1
    assert len(a.review_id) == 32 and a.review_id == a.review_id.upper()


def test_sample_is_reproducible(spark):
    df = spark.range(0, 2000).select(F.col("id").cast("string").alias("text"),
                                     F.lit("3").alias("rating"), F.col("id").alias("k"))
    a = normalise_reviews(df, key_col="k", sample_n=100, seed=42).select("review_id").collect()
    b = normalise_reviews(df.repartition(7), key_col="k", sample_n=100, seed=42).select("review_id").collect()
    assert len(a) == 100 and sorted(a) == sorted(b)
