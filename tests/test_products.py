"""Rating deviation, summaries and bursts on literal rows."""

import datetime as dt

from veracity.operators.products import hourly_bursts, rating_deviation


def test_rating_deviation_classes(spark):
    rows = [("gen_only", 4.0, 0.1), ("gen_only", 2.0, None),
            ("fake_only", 5.0, 0.9),
            ("both", 5.0, 0.9), ("both", 5.0, 0.5), ("both", 1.0, 0.2), ("both", 2.0, None)]
    df = spark.createDataFrame(rows, "product_asin string, rating double, fake_probability double")
    strict = {r.product_asin: r for r in rating_deviation(df).collect()}
    assert set(strict) == {"both"}
    b = strict["both"]
    assert (b.fake_review_count, b.genuine_review_count) == (2, 2)   # null probability is genuine
    assert (b.fake_avg, b.genuine_avg, b.rating_inflation, b.overall_avg) == (5.0, 1.5, 3.5, 3.25)
    loose = {r.product_asin: r for r in rating_deviation(df, require_both=False).collect()}
    assert loose["gen_only"].fake_avg == 0.0 and loose["gen_only"].rating_inflation == -3.0
    assert loose["fake_only"].genuine_avg == 0.0


def test_half_even_rounding_of_means(spark):
    # mean 2.125 exactly: half-even gives 2.12
    rows = [("p", r, 0.9) for r in (2.0, 2.0, 2.0, 2.0, 2.0, 2.0, 2.0, 3.0)] + [("p", 1.0, 0.0)]
    df = spark.createDataFrame(rows, "product_asin string, rating double, fake_probability double")
    r = rating_deviation(df).collect()[0]
    assert r.fake_avg == 2.12


def test_hourly_buckets(spark):
    t = dt.datetime(2024, 1, 1, 10, 0)
    rows = [("p", t + dt.timedelta(minutes=m), 4.0, 0.7) for m in (0, 10, 20, 30, 59)]
    rows += [("p", t + dt.timedelta(minutes=61), 4.0, 0.7)]
    df = spark.createDataFrame(rows, "product_asin string, scraped_at timestamp_ntz, rating double, fake_probability double")
    out = hourly_bursts(df, threshold=5).collect()
    assert [(r.hour, r.review_count, r.fake_count) for r in out] == [("2024-01-01-10", 5, 5)]
    two = hourly_bursts(df, window_hours=2, threshold=6).collect()
    assert [(r.hour, r.review_count) for r in two] == [("2024-01-01-10", 6)]
