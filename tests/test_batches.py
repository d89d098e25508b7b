"""Text measures, term counts and text vectors by the batch: the same as text by text, and no step a word."""

import random
import re
from collections import Counter

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from veracity.functions import lexicons as lx
from veracity.functions import text as tx
from veracity.functions.measures import MEASURE, Measures, measured
from veracity.ml import features as mf
from veracity.operators import reviewers as rv
from veracity.operators import signals as sg

PIECES = ["free", "Free", "freedom", "fre", "e", "buy now", "BUY  NOW", "great", "GREAT!", "éfree", "freeé", "love", "LOVE", "hate", "junk",
          "Kill broKen", "uſeleſs", "İ", "ı", "awful", "scam", "scam_", "http://x", "HTTPS://y", "httpſ://", "!", "!!!!!", " ", "  ",
          "\n", "\t\r\n", " ", " ", "　", "\x1c", "\x85", "Ünïcode", "ÀÉ", "Ⅷ", "ǅ", "中文", "中", "a", "I", "_", "__", "x1", "9",
          "😀", "\U00010400", "the", "don't", "\x00", "٣٤", "²", "ª", "ࡰࡱ", "x" * 70, "é" * 40]


def _texts(n, seed=5):
    rng = random.Random(seed)
    made = ["".join(p + rng.choice(["", " ", " ", "\n"]) for p in rng.choices(PIECES, k=rng.randint(0, 30))) for _ in range(n)]
    return made + ["", " ", "  \n", None, "a", "  lead", "trail  ", "in  between"]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(k, t, float(k % 6), k % 2) for k, t in enumerate(_texts(400))]
    return spark.createDataFrame(rows, "k int, body string, rating double, helpful_votes int").repartition(3).cache()


def test_measures_are_those_of_the_expressions(spark, texts):
    body = F.coalesce("body", F.lit(""))
    want = {"word_count": tx.word_count(body), "uppercase_count": tx.uppercase_count(body),
            "exclamation_count": tx.exclamation_count(body), "has_url": tx.has_url(body)}
    want |= {f"spam_{p}": tx.spam_hit(body, p) for p in ("scoring", "loader", "trainer")}
    want |= {"positive_word": tx.lexicon_hit(body, lx.POSITIVE_WORDS), "negative_word": tx.lexicon_hit(body, lx.NEGATIVE_WORDS),
             "negative_loader": tx.lexicon_hit(body, lx.NEGATIVE_WORDS_LOADER)}
    want |= {k: tx.lexicon_hit(body, w, "substring") for k, w in Measures.SUBSTRING.items()}
    assert set(want) == set(Measures.NAMES)
    got = measured(texts, Measures.NAMES)
    for name, c in want.items():
        odd = got.where(F.col(MEASURE + name) != c).select("body", MEASURE + name).collect()
        assert not odd, (name, odd[:3])
        assert 1 < got.groupBy(MEASURE + name).count().count(), name          # both outcomes occur


def test_signals_and_labels_read_measures(spark, texts):
    got, plain = measured(texts, Measures.NAMES), texts
    for f in (lambda d: sg.review_signals(d), lambda d: sg.lexicon_signals(d, "hql"), lambda d: sg.lexicon_signals(d, "word")):
        a, b = f(got), f(plain)
        assert a.select(b.columns).exceptAll(b).count() == 0 and "regexp" not in a.drop("body")._jdf.queryExecution().optimizedPlan().toString()
    points = got.select("k", sg.label_points(df=got).alias("p")).exceptAll(plain.select("k", sg.label_points().alias("p")))
    assert points.count() == 0


def test_flags_of_measured_reviews_read_no_text(spark):
    rows = [(str(k), f"u{k % 3}" if k % 4 else None, 5.0, "free great text", False, 0, "p", None) for k in range(20)]
    d = spark.createDataFrame(rows, "review_id string, reviewer_id string, rating double, body string, verified_purchase boolean, "
                                    "helpful_votes int, product_asin string, date string")
    a, b = rv.fraud_scores(d, measure=sg.SENTIMENT_MEASURES), rv.fraud_scores(d)
    cols = [c for c in b.columns if c not in ("has_url", "exclamation_count", "caps_ratio")]
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0 and a.count() == b.count()
    flags = rv.fraud_scores(d, measure=sg.SENTIMENT_MEASURES).select("reviewer_id", "reviewer_flags.total_reviews")
    assert flags._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def _brute(texts, min_df, stop=()):
    tf, df = Counter(), Counter()
    for t in texts:
        w = [x for x in re.findall(r"(?:(?![ࡰࡱ])\w){2,}", (t or "").lower()) if x not in stop]
        s = w + [f"{a} {b}" for a, b in zip(w, w[1:])]
        tf.update(s)
        df.update(set(s))
    return sorted((-tf[t], t, df[t]) for t in tf if df[t] >= min_df)


def test_terms_are_counted_by_the_batch(spark):
    texts = [t for t in _texts(300, 9) if t is None or "İ" not in t]
    rng = random.Random(1)
    texts += [" ".join(f"w{min(int(rng.paretovariate(0.4)), 5000)}" for _ in range(60)) for _ in range(200)]      # long tail
    texts += ["zz " * 500]                                                    # often, but in one text
    d = spark.createDataFrame([(t,) for t in texts], "body string").repartition(4)
    for top in (1, 7, 40, 300, None):
        got = [(-r.term_freq, r.term, r.doc_freq) for r in mf.term_doc_freq(d, min_df=2, top=top).collect()]
        assert got == _brute(texts, 2)[:top], top
    got = [(-r.term_freq, r.term, r.doc_freq) for r in mf.term_doc_freq(d, min_df=2, top=20, stop_words=lx.STOP_WORDS).collect()]
    assert got == _brute(texts, 2, set(lx.STOP_WORDS))[:20]
    assert "Generate" not in mf.term_doc_freq(d, top=20)._jdf.queryExecution().optimizedPlan().toString()     # no row a word


def test_terms_in_single_texts_do_not_hide_others(spark):
    """The fullest buckets hold words of one text each: all terms are then counted."""
    texts = [f"only{k} " * 50 for k in range(60)] + [f"pair{k} x" for k in range(40)] * 2
    d = spark.createDataFrame([(t,) for t in texts], "body string").repartition(3)
    got = [(-r.term_freq, r.term, r.doc_freq) for r in mf.term_doc_freq(d, min_df=2, top=10).collect()]
    assert got == _brute(texts, 2)[:10]


def test_vocabulary_vectors_are_those_of_the_stages(spark, texts):
    d = texts.select(F.col("k").alias("review_id"), "body")
    vocabulary, idf = mf.fit_vocabulary(d, 30)
    model = mf.vocab_text_model(vocabulary, idf)
    want = {r.review_id: r.tfidf for r in model.transform(d.fillna("")).select("review_id", "tfidf").collect()}
    from veracity.ml.terms import Weigher
    fast = mf._with_vector(d, Weigher(spark, vocabulary, idf, lx.STOP_WORDS), len(vocabulary), "tfidf")
    assert {r.review_id: r.tfidf for r in fast.collect()} == want
    rows = {(r.review_id, r.term): r.weight for r in mf.tfidf_weights(d, 30).collect()}
    assert rows == {(k, vocabulary[i]): v.values[j] for k, v in want.items() for j, i in enumerate(v.indices) if v.values[j]}


def test_hashed_vectors_are_those_of_the_stages(spark, texts):
    from veracity.ml.terms import Hasher
    d = texts.select("k", F.coalesce("body", F.lit("")).alias("body"))
    stages = mf.hashed_text_pipeline(500).getStages()[:3]
    want = {r.k: r.raw_tf for r in Pipeline(stages=stages).fit(d).transform(d).select("k", "raw_tf").collect()}
    fast = mf._with_vector(d, Hasher([w.lower() for w in stages[1].getStopWords()], 500), 500, "raw_tf")
    got = {r.k: r.raw_tf for r in fast.collect()}
    assert got == want


def test_hashed_features_run_no_stage_a_word(spark):
    cols = {c: F.lit(0.5) for c in mf.CLUSTER_NUMERIC_FEATURES}
    d = spark.createDataFrame([(1, "the cat sat"), (2, "a cat  ran"), (3, "")], "review_id int, body string").withColumns(cols)
    model, out = mf.fit_hashed_text_features(d, 64)
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "filtered_words" not in plan
    by = {r.review_id: r.features for r in out.collect()}
    assert by == {r.review_id: r.features for r in model.transform(d).collect()}
