"""Literal-row tests of the per-review signals at their boundaries."""

from pyspark.sql import Row

from veracity.operators.signals import fake_label, label_points, lexicon_signals, review_signals, weak_labels


def _sig(spark, rows):
    df = spark.createDataFrame([Row(review_id=str(i), **r) for i, r in enumerate(rows)],
                               "review_id string, body string, rating double, helpful_votes int")
    return {r.review_id: r for r in review_signals(df).collect()}


def test_length_rules(spark):
    pad = "abcdefghij" * 10
    rows = [dict(body=pad[:19], rating=3.0, helpful_votes=1),   # < 20: spam
            dict(body=pad[:20], rating=3.0, helpful_votes=1),   # 20: not
            dict(body=pad[:49], rating=5.0, helpful_votes=0),   # short extreme: spam
            dict(body=pad[:50], rating=5.0, helpful_votes=0),   # 50: not
            dict(body=pad[:49], rating=5.0, helpful_votes=1),   # helpful: not
            dict(body=pad[:49], rating=2.0, helpful_votes=0),   # not extreme: not
            dict(body=pad[:49], rating=1.0, helpful_votes=0)]   # spam
    out = _sig(spark, rows)
    assert [out[str(i)].spam_flag for i in range(7)] == [True, False, True, False, False, False, True]


def test_spam_words_are_word_bounded_and_case_insensitive(spark):
    base = "a perfectly ordinary sentence of some length "
    rows = [dict(body=base + "éfree", rating=3.0, helpful_votes=1),
            dict(body=base + "freedom", rating=3.0, helpful_votes=1),
            dict(body=base + "FREE", rating=3.0, helpful_votes=1),
            dict(body=base + "HTTP://x", rating=3.0, helpful_votes=1),
            dict(body=base + "promo code here", rating=3.0, helpful_votes=1),
            dict(body=base + "click  here", rating=3.0, helpful_votes=1)]
    out = _sig(spark, rows)
    assert [out[str(i)].spam_flag for i in range(6)] == [False, False, True, True, True, False]
    # has_url is case-sensitive, the spam regex is not
    assert out["3"].has_url is False


def test_word_count_and_caps(spark):
    rows = [dict(body="", rating=3.0, helpful_votes=0),
            dict(body="   ", rating=3.0, helpful_votes=0),
            dict(body="É a", rating=3.0, helpful_votes=0),
            dict(body="one two\tthree\x1cfour", rating=3.0, helpful_votes=0),
            dict(body=None, rating=None, helpful_votes=None)]
    out = _sig(spark, rows)
    assert [out[str(i)].word_count for i in range(5)] == [0, 0, 2, 4, 0]
    assert out["2"].caps_ratio == 1 / 3
    assert out["0"].caps_ratio == 0.0
    assert out["4"].spam_flag is True  # empty body is shorter than 20


def test_exclamations(spark):
    out = _sig(spark, [dict(body="wow!!! great!", rating=3.0, helpful_votes=0)])
    assert out["0"].exclamation_count == 4


def test_lexicon_presets(spark):
    df = spark.createDataFrame([("1", "It is the greatest, not awful", 5.0),
                                ("2", "This is a SCAM", 4.0),
                                ("3", "useless", 3.0)], "review_id string, body string, rating double")
    word = {r.review_id: r for r in lexicon_signals(df, "word").collect()}
    hql = {r.review_id: r for r in lexicon_signals(df, "hql").collect()}
    assert (word["1"].positive_signal, hql["1"].positive_signal) == (0, 1)   # 'greatest'
    assert word["1"].rating_sentiment_mismatch == 1
    assert (word["2"].rating_sentiment_mismatch, hql["2"].rating_sentiment_mismatch) == (1, 0)  # no 'scam' in SQL list
    assert word["3"].rating_sentiment_mismatch == 0


def test_weak_label_rules(spark):
    rows = [("a", "Great!", 5.0),                          # 35 + 15 = 50 -> fake
            ("b", "ok fine", 1.0),                         # 35 -> genuine
            ("c", "this has five real words", 5.0),        # 15 -> genuine
            ("d", "buy now and it is broken badly though here", 4.0),  # 30 + 35
            ("e", "amazing amazing amazing product", 3.0), # 20
            ("f", "THIS IS LOUD and on", 3.0),                           # caps 10/19 > 0.3: 20
            ("g", "a b c d e f g h i j k l m n o p q r s!!!!!", 3.0)]  # 20
    df = spark.createDataFrame(rows, "review_id string, body string, rating double")
    out = {r.review_id: (r.label_points, r.is_fake_ground_truth) for r in weak_labels(df).collect()}
    assert out == {"a": (50, 1), "b": (35, 0), "c": (15, 0), "d": (65, 1), "e": (20, 0),
                   "f": (20, 0), "g": (20, 0)}


def test_non_breaking_space_separates_words(spark):
    out = _sig(spark, [dict(body="one\xa0two three", rating=3.0, helpful_votes=0)])
    assert out["0"].word_count == 3


def test_sentiment_table_body_length_filter(spark):
    from pyspark.sql import functions as F

    from veracity.operators.products import review_sentiments
    from veracity.operators.reviewers import fraud_scores
    rows = [("a", "u1", "x" * 10, 3.0), ("b", "u1", "x" * 11, 3.0), ("c", "u1", None, 3.0)]
    df = spark.createDataFrame(rows, "review_id string, reviewer_id string, body string, rating double") \
        .withColumn("date", F.lit("Unknown")).withColumn("product_asin", F.lit("p"))
    sql_form = {r.review_id for r in review_sentiments(fraud_scores(df), 10, "hql").collect()}
    local_form = {r.review_id for r in review_sentiments(fraud_scores(df), None, "word").collect()}
    assert sql_form == {"b"} and local_form == {"a", "b", "c"}


def test_fake_label_is_points_at_the_threshold(spark):
    """The label without points is the label by points, whichever rules decide and whatever is missing."""
    long = " plain words that say little about this thing but go on for a while anyway yes"
    bodies = [None, "", "ok", "great best love", "free scam", "BUY NOW!!!!!", "great best love free", "AWFUL" + long.upper(),
              "free" + long, "scam" + long, "free scam" + long, "free" + long + "!!!!!", "scam" + long + "!!!!!",
              "FREE" + long.upper(), "PLAIN" + long.upper() + "!!!!!", "ſcam diſcount" + long, "freİe scamper" + long]
    rows = [(b, r) for b in bodies for r in (None, 1.0, 2.0, 4.0, 5.0)]
    d = spark.createDataFrame(rows, "body string, rating double")
    out = d.select("body", "rating", (label_points() >= 50).cast("int").alias("by_points"), fake_label().alias("label")).collect()
    assert [r for r in out if r["label"] != r["by_points"]] == []
    assert {r["label"] for r in out} == {0, 1}
