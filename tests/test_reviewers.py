"""Reviewer flags, burst detection and the fraud score on literal rows."""

import datetime as dt
import itertools
import random

from pyspark.sql import functions as F

from veracity.operators.reviewers import (fraud_scores, reviewer_activity, reviewer_bursts, reviewer_flags,
                                          reviewer_frequency)

SCHEMA = ("review_id string, reviewer_id string, rating double, body string, date string, "
          "verified_purchase boolean, helpful_votes int")


def _date(d):
    return "Reviewed in the United States on " + d.strftime("%B %d, %Y")


def _rows(reviewer, days, rating=3.0, verified=True, body="a perfectly ordinary review text here"):
    base = dt.date(2024, 1, 10)
    return [(f"{reviewer}-{i}", reviewer, rating, body,
             _date(base + dt.timedelta(days=d)) if d is not None else "Unknown", verified, 1)
            for i, d in enumerate(days)]


def test_burst_cases(spark):
    rows = (_rows("five_one_day", [0] * 5) + _rows("three_two", [0, 0, 0, 1, 1])
            + _rows("four_one_day", [0] * 4) + _rows("five_three_days", [0, 0, 1, 2, 2])
            + _rows("undated", [None] * 6) + _rows("spread", [0, 2, 4, 6, 8, 10]))
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.reviewer_id: r.burst_activity for r in reviewer_bursts(df).collect()}
    assert got == {"five_one_day": True, "three_two": True, "four_one_day": False,
                   "five_three_days": False, "undated": False, "spread": False}


def _brute_burst(days, k=5, hours=24):
    ds = sorted(days)
    return any((ds[i + k - 1] - ds[i]).total_seconds() / 3600 <= hours for i in range(len(ds) - k + 1))


def test_burst_matches_brute_force(spark):
    rnd = random.Random(7)
    rows, truth = [], {}
    base = dt.datetime(2024, 1, 1)
    for r in range(60):
        n = rnd.randint(0, 12)
        days = [rnd.randint(0, rnd.choice([3, 10, 40])) for _ in range(n)]
        dated = [base + dt.timedelta(days=d) for d in days]
        for hours, k in ((24, 5), (48, 4)):
            truth[(f"r{r}", hours, k)] = _brute_burst(dated, k, hours)
        rows += [(f"r{r}-{i}", f"r{r}", 3.0, "x" * 30, _date(d), True, 1) for i, d in enumerate(dated)]
    df = spark.createDataFrame(rows, SCHEMA)
    for hours, k in ((24, 5), (48, 4)):
        got = {r.reviewer_id: r.burst_activity for r in reviewer_bursts(df, k=k, hours=hours).collect()}
        for rid, val in got.items():
            assert val == truth[(rid, hours, k)], (rid, hours, k)


def test_flags(spark):
    rows = (_rows("one", [0], rating=4.0)
            + [(f"u-{i}", "unv", 5.0 if i % 2 else 1.0, "x" * 30, "Unknown", i == 0, 1) for i in range(5)]
            + [(f"n-{i}", None, 2.0, "x" * 30, "Unknown", False, 1) for i in range(2)])
    df = spark.createDataFrame(rows, SCHEMA)
    f = {r.reviewer_id: r for r in reviewer_flags(df).collect()}
    assert f["one"].rating_std == 0.0 and f["one"].total_reviews == 1
    assert f["unv"].unverified_ratio == 0.8 and f["unv"].unverified_over_limit is False
    assert f["unv"].all_extreme_ratings is True
    assert f["UNKNOWN"].total_reviews == 2   # null reviewer kept under the default id


def test_score_all_combinations(spark):
    rows = []
    expected = {}
    for i, (extreme, burst, unverified, spam) in enumerate(itertools.product([False, True], repeat=4)):
        rid = f"c{i}"
        rating = 5.0 if extreme else 3.0
        days = [0] * 5 if burst else [0, 3, 6, 9, 12]
        body = "buy now" if spam else "a perfectly ordinary review text here, long enough"
        rows += [(f"{rid}-{j}", rid, rating, body,
                  _date(dt.date(2024, 1, 1) + dt.timedelta(days=d)), not unverified, 1)
                 for j, d in enumerate(days)]
        expected[rid] = min(3 * extreme + 3 * burst + 2 * unverified + 2 * spam, 10) / 10
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.reviewer_id: r.reviewer_fraud_score for r in fraud_scores(df).collect()}
    assert got == expected
    verdicts = {r.reviewer_id: r.verdict for r in fraud_scores(df).collect()}
    assert all((verdicts[k] == "FAKE") == (v >= 0.5) for k, v in expected.items())


def test_tenths_threshold():
    from veracity.functions.numeric import tenths_threshold
    assert [tenths_threshold(x) for x in (0.5, 0.45, 0.55, 0.3, 0.0, 1.0)] == [5, 5, 6, 3, 0, 10]


def test_activity_covers_the_reviewers_of_frequency(spark):
    at = [dt.datetime(2024, 1, d) for d in (1, 2, 2, 3)]
    rows = ([(None, p, t) for p, t in zip(["P1", None, "P1", "UNKNOWN"], at)]
            + [("UNKNOWN", "P2", t) for t in at[:3]] + [("U1", "P3", t) for t in at[:2]])
    df = spark.createDataFrame(rows, "reviewer_id string, product_asin string, scraped_at timestamp_ntz")
    df = df.selectExpr("*", "3.0D as rating", "0.1D as fake_probability").repartition(3)
    freq = {r.reviewer_id: r for r in reviewer_frequency(df).collect()}
    assert set(freq) == {None, "UNKNOWN"}
    times = [tuple(r) for r in reviewer_activity(df, "times").collect()]
    assert sorted(times, key=str) == sorted([(r, t) for r, _, t in rows if r != "U1"], key=str)
    products = [tuple(r) for r in reviewer_activity(df, "products").collect()]
    assert sorted(products, key=str) == sorted([(None, "P1"), (None, "UNKNOWN"), ("UNKNOWN", "P2")], key=str)
    for k, r in freq.items():
        assert r.total_reviews == sum(x == k for x, _ in times)
        assert r.unique_products == sum(x == k for x, _ in products)


def test_text_crosses_no_shuffle_where_it_is_asked_for(spark):
    import contextlib
    import io
    import re

    import __spark_entry__ as entry
    from conftest import SF_SMALL
    from veracity.operators import reviewers as rv
    for key in ("review_sentiments", "top_suspicious_reviews", "feature_preview"):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            entry.queries()[key](spark, SF_SMALL).explain(mode="formatted")
        blocks = re.findall(r"\(\d+\) (?:Exchange|BroadcastExchange)\nInput \[\d+\]: \[([^\]]*)\]", buf.getvalue())
        assert blocks and not any("body" in cols and "reviewer_id" in cols for cols in blocks), key
    rows = [(str(k), f"U{k % 3}" if k % 5 else None, 5.0, "some text of a review", True) for k in range(40)]
    d = spark.createDataFrame(rows, "review_id string, reviewer_id string, rating double, body string, verified_purchase boolean")
    d = d.withColumn("date", F.lit("Reviewed in the United States on January 01, 2024"))
    plain = sorted(map(str, rv.fraud_scores(d).collect()))
    for limit in (1, rv.BROADCAST_ROWS):                # above the limit: the plain join
        assert sorted(map(str, rv.fraud_scores(d, broadcast_rows=limit).collect())) == plain
