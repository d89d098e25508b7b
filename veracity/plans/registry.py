"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver's tables for ``sf_dir`` (through the
``reviews`` mapping), runs the library operator its name refers to, and
projects flat, explicitly named columns that the DuckDB statement in
``veracity.plans.oracle`` returns too. Four ML keys (fitted feature
pipelines, random oversampling, a trained model) have no SQL statement and
get the driver's rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.ml import evaluate as ev
from veracity.ml import features as mf
from veracity.operators import normalise as nm
from veracity.operators import products as pr
from veracity.operators import reports as rp
from veracity.operators import reviewers as rv
from veracity.operators import sampling as sm
from veracity.operators import signals as sg
from veracity.sources import pages as pg
from veracity.sources.fixture import review_pages_from_tables, review_source_from_tables, reviews_from_tables
from veracity.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews_from_tables(spark, sf_dir)


def scored_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with a model's ``fake_probability``: what the three document-store
    analyses read (they use no reviewer flag or fraud score)."""
    return reviews(spark, sf_dir)


def processed(spark: SparkSession, sf_dir: str, with_text: bool = False, measure: list[str] = ()) -> DataFrame:
    """Reviews through the scoring job: signals, reviewer flags, score. ``with_text`` for those who read the
    body afterwards: it then crosses no shuffle. ``measure``: see ``fraud_scores``."""
    return rv.fraud_scores(reviews(spark, sf_dir), broadcast_rows=rv.BROADCAST_ROWS if with_text else None, measure=measure)


@register("review_signals")
def q_review_signals(spark, sf_dir):
    return sg.review_signals(reviews(spark, sf_dir)).select(
        "review_id", "reviewer_id", "spam_flag", "word_count", "has_url", "exclamation_count",
        "caps_ratio")


@register("reviewer_bursts")
def q_reviewer_bursts(spark, sf_dir):
    return rv.reviewer_bursts(reviews(spark, sf_dir)).select("reviewer_id", "burst_activity")


@register("reviewer_flags")
def q_reviewer_flags(spark, sf_dir):
    return rv.reviewer_flags(reviews(spark, sf_dir)).drop("unverified_over_limit")


@register("fraud_scores")
def q_fraud_scores(spark, sf_dir):
    p = processed(spark, sf_dir)
    return p.select("review_id", "reviewer_id", "product_asin", "spam_flag",
                    *[F.col(f"reviewer_flags.{c}").alias(c) for c in rv.FLAG_FIELDS],
                    "reviewer_fraud_score", "verdict")


def sentiments(spark: SparkSession, sf_dir: str, preset: str = "hql", with_text: bool = False) -> DataFrame:
    """The sentiment table: SQL form (body > 10 chars, substring lists) or local form.

    Sentiment signals are added to the reviews before scoring, so they are
    computed where the text is read and never need the text after the join.
    """
    if with_text and preset == "hql":       # by the batch, after the join
        p = processed(spark, sf_dir, with_text=True, measure=sg.SENTIMENT_MEASURES)
    else:
        p = rv.fraud_scores(sg.lexicon_signals(reviews(spark, sf_dir), preset=preset),
                            broadcast_rows=rv.BROADCAST_ROWS if with_text else None)
    if preset == "hql":
        return pr.review_sentiments(p, min_body_length=10, preset="hql")
    return pr.review_sentiments(p, min_body_length=None, preset="word")


@register("lexicon_signals")
def q_lexicon_signals(spark, sf_dir):
    r = reviews(spark, sf_dir).select("review_id", "body", "rating")
    cols = ["positive_signal", "negative_signal", "rating_sentiment_mismatch"]
    w = sg.lexicon_signals(r, preset="word")
    h = sg.lexicon_signals(w.select("review_id", "body", "rating", *[F.col(c).alias(c + "_word") for c in cols]),
                           preset="hql")
    return h.select("review_id", *[F.col(c + "_word").alias(c) for c in cols],
                    *[F.col(c).alias(c + "_hql") for c in cols])


@register("review_sentiments")
def q_review_sentiments(spark, sf_dir):
    return sentiments(spark, sf_dir, "hql", with_text=True).select(*pr.SENTIMENT_COLUMNS)


@register("suspicious_reviewers")
def q_suspicious_reviewers(spark, sf_dir):
    return rv.suspicious_reviewers(sentiments(spark, sf_dir, "hql"), min_reviews=4)


@register("suspicious_reviewers_min2")
def q_suspicious_reviewers_min2(spark, sf_dir):
    return rv.suspicious_reviewers(sentiments(spark, sf_dir, "word"), min_reviews=2,
                                   mismatch_col="mismatch_count")


@register("product_fraud_summary")
def q_product_fraud_summary(spark, sf_dir):
    return pr.product_fraud_summary(sentiments(spark, sf_dir, "hql"), with_stddev=True)


@register("product_fraud_summary_basic")
def q_product_fraud_summary_basic(spark, sf_dir):
    return pr.product_fraud_summary(sentiments(spark, sf_dir, "word"), with_stddev=False)


@register("daily_review_bursts")
def q_daily_review_bursts(spark, sf_dir):
    return pr.daily_review_bursts(sentiments(spark, sf_dir, "hql"), min_count=11, day="raw")


@register("daily_review_bursts_min3")
def q_daily_review_bursts_min3(spark, sf_dir):
    return pr.daily_review_bursts(sentiments(spark, sf_dir, "word"), min_count=3, day="clean")


@register("reviewer_frequency")
def q_reviewer_frequency(spark, sf_dir):
    return rv.reviewer_frequency(scored_reviews(spark, sf_dir))


@register("reviewer_times")
def q_reviewer_times(spark, sf_dir):
    return rv.reviewer_activity(scored_reviews(spark, sf_dir), "times")


@register("reviewer_products")
def q_reviewer_products(spark, sf_dir):
    return rv.reviewer_activity(scored_reviews(spark, sf_dir), "products")


@register("suspicious_reviewers_head")
def q_suspicious_reviewers_head(spark, sf_dir):
    return rp.table_heads({"t": q_suspicious_reviewers(spark, sf_dir)}, n=10)["t"]


@register("product_fraud_summary_head")
def q_product_fraud_summary_head(spark, sf_dir):
    return rp.table_heads({"t": q_product_fraud_summary(spark, sf_dir)}, n=10)["t"]


@register("hourly_bursts")
def q_hourly_bursts(spark, sf_dir):
    return pr.hourly_bursts(scored_reviews(spark, sf_dir), window_hours=1, threshold=5)


@register("rating_deviation")
def q_rating_deviation(spark, sf_dir):
    return pr.rating_deviation(scored_reviews(spark, sf_dir))


@register("rating_inflation_report")
def q_rating_inflation_report(spark, sf_dir):
    return pr.rating_deviation(processed(spark, sf_dir), by="score_tenths", threshold=5,
                               require_both=False)


@register("analytics_snapshot")
def q_analytics_snapshot(spark, sf_dir):
    return rp.snapshot(scored_reviews(spark, sf_dir), k=50).drop("generated_at")


@register("overall_summary")
def q_overall_summary(spark, sf_dir):
    return rp.overall_summary(processed(spark, sf_dir))


@register("reviewer_report")
def q_reviewer_report(spark, sf_dir):
    return rv.reviewer_report(processed(spark, sf_dir), n=5)


@register("burst_reviewers")
def q_burst_reviewers(spark, sf_dir):
    return rv.burst_reviewers(processed(spark, sf_dir), n=5)


@register("top_suspicious_reviews")
def q_top_suspicious_reviews(spark, sf_dir):
    return rp.top_suspicious_reviews(processed(spark, sf_dir, with_text=True), n=5)


@register("feature_preview")
def q_feature_preview(spark, sf_dir):
    return rp.feature_preview(processed(spark, sf_dir, with_text=True), n=5)


def normalised(spark: SparkSession, sf_dir: str, sample_n: int | None = None) -> DataFrame:
    """The CSV-layout source through the normaliser (scrape time fixed for comparison)."""
    src = review_source_from_tables(spark, sf_dir)
    return nm.normalise_reviews(src, key_col="source_row", sample_n=sample_n, seed=42,
                                scraped_at=F.lit("2024-02-01 00:00:00").cast("timestamp"))


@register("normalise_reviews")
def q_normalise_reviews(spark, sf_dir):
    return normalised(spark, sf_dir).drop("scraped_at")


@register("sample_reviews")
def q_sample_reviews(spark, sf_dir):
    return normalised(spark, sf_dir, sample_n=5000).select(
        "review_id", "reviewer_id", "rating", "is_fake_ground_truth")


@register("rating_distribution")
def q_rating_distribution(spark, sf_dir):
    return rp.rating_distribution(normalised(spark, sf_dir))


@register("review_dates")
def q_review_dates(spark, sf_dir):
    return nm.parse_review_dates(reviews(spark, sf_dir)).select("review_id", "date_clean", "review_day")


@register("weak_labels")
def q_weak_labels(spark, sf_dir):
    return sg.weak_labels(reviews(spark, sf_dir)).select("review_id", "label_points",
                                                          "is_fake_ground_truth")


def features(spark: SparkSession, sf_dir: str, with_text: bool = False) -> DataFrame:
    if with_text:
        return mf.feature_table(processed(spark, sf_dir, with_text=True, measure=mf.FEATURE_MEASURES))
    return mf.feature_table(rv.fraud_scores(mf.with_text_features(reviews(spark, sf_dir))))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """review_id and the weak label (rules on text and rating only: no reviewer flags needed)."""
    return reviews(spark, sf_dir).select("review_id", sg.fake_label().alias("label"))


def reused(df: DataFrame) -> DataFrame:
    """Persist an input that several passes read (ML fits, rank histogram + rows).

    MEMORY_AND_DISK: blocks lost with an executor are recomputed from lineage.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)


@register("feature_table")
def q_feature_table(spark, sf_dir):
    return features(spark, sf_dir).drop("body")


@register("proxy_labels")
def q_proxy_labels(spark, sf_dir):
    return mf.proxy_labels(processed(spark, sf_dir)).select("review_id", "label")


@register("class_balance")
def q_class_balance(spark, sf_dir):
    return rp.class_balance(mf.proxy_labels(processed(spark, sf_dir)))


@register("term_doc_freq")
def q_term_doc_freq(spark, sf_dir):
    return mf.term_doc_freq(reviews(spark, sf_dir), min_df=2, top=300)


@register("balanced_counts")
def q_balanced_counts(spark, sf_dir):
    b = sm.balance_exact(reused(labelled(spark, sf_dir)), seed=42)
    return b.groupBy("review_id", "label").agg(F.count(F.lit(1)).alias("copies"))


@register("stratified_split")
def q_stratified_split(spark, sf_dir):
    return sm.stratified_split(reused(labelled(spark, sf_dir)),
                               test_frac=0.2, seed=42)


@register("label_noise")
def q_label_noise(spark, sf_dir):
    return sm.label_noise(reused(labelled(spark, sf_dir)), frac=0.05, seed=42)


def evaluation_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak labels against the reviews' model-like ``fake_probability``."""
    return sg.weak_labels(reviews(spark, sf_dir)).select(
        "review_id", F.col("is_fake_ground_truth").alias("label"), F.col("fake_probability").alias("score"))


@register("classifier_metrics")
def q_classifier_metrics(spark, sf_dir):
    return ev.classifier_metrics(evaluation_input(spark, sf_dir), threshold=0.5)


@register("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    d = evaluation_input(spark, sf_dir).filter(F.col("score").isNotNull())
    return ev.confusion_matrix(d.withColumn("prediction", (F.col("score") >= 0.5).cast("int")))


@register("per_class_report")
def q_per_class_report(spark, sf_dir):
    d = evaluation_input(spark, sf_dir).filter(F.col("score").isNotNull())
    return ev.per_class_report(d.withColumn("prediction", (F.col("score") >= 0.5).cast("int")))


@register("roc_curve")
def q_roc_curve(spark, sf_dir):
    return ev.roc_curve(evaluation_input(spark, sf_dir))


@register("extract_page_records")
def q_extract_page_records(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return pg.extract_page_records(pages, layout="article")


@register("extract_review_records")
def q_extract_review_records(spark, sf_dir):
    """The review layout over every page (wrapped into it by the fixture)."""
    return pg.extract_page_records(review_pages_from_tables(spark, sf_dir), layout="review").drop("scraped_at")


@register("tfidf_weights")
def q_tfidf_weights(spark, sf_dir):
    """The local trainer's TF-IDF matrix as rows."""
    rows = mf.tfidf_weights(reviews(spark, sf_dir).select("review_id", "body"))
    return rows.select("review_id", "term", F.round("weight", 6).alias("weight"))


_FITTED: dict = {}


def fitted_models(spark: SparkSession, sf_dir: str):
    """Both local models (reference settings, five-fold cross-validation), fitted once a session for the
    queries that read them: models by name, their metrics, the held-out part."""
    from veracity.ml import train as tr
    key = (spark.sparkContext.applicationId, sf_dir, tr.local_models)
    if key not in _FITTED:
        _FITTED.clear()
        _FITTED[key] = tr.fit_local(features(spark, sf_dir, with_text=True), cv_folds=5)
    return _FITTED[key]


@register("model_scores")
def q_model_scores(spark, sf_dir):
    """Train both local models and score the held-out part: a row per review and model, with the
    model's metrics.

    Rows-only check: no SQL statement can express the trained models.
    """
    from veracity.ml.score import score_reviews
    fitted, metrics, test = fitted_models(spark, sf_dir)
    scored = None
    for name, model in fitted.items():
        one = score_reviews(test, model).select(F.lit(name).alias("model"), "review_id", "label", "prediction",
                                                "fake_probability")
        scored = one if scored is None else scored.unionByName(one)
    return scored.join(F.broadcast(metrics), "model")             # one row a model


@register("model_metrics")
def q_model_metrics(spark, sf_dir):
    """Metrics of both local models and which one is best by AUC. Rows-only check (trained)."""
    _, metrics, _ = fitted_models(spark, sf_dir)
    best = ev.best_model(metrics).select("model", F.lit(True).alias("best"))
    return metrics.join(F.broadcast(best), "model", "left").fillna({"best": False})


@register("feature_importances")
def q_feature_importances(spark, sf_dir):
    """Every feature's importance in each local model, named by the model itself. Rows-only check."""
    fitted, _, test = fitted_models(spark, sf_dir)
    out = None
    for name, model in fitted.items():
        one = ev.feature_importances(model.stages[-1], mf.feature_names(model, test), spark, n=None)
        one = one.select(F.lit(name).alias("model"), "feature", "importance")
        out = one if out is None else out.unionByName(one)
    return out


@register("gbt_grid_scores")
def q_gbt_grid_scores(spark, sf_dir):
    """Cluster trainer's grid: mean AUC over the folds per setting. Rows-only check (trained)."""
    from veracity.ml import train as tr
    return tr.gbt_grid(processed(spark, sf_dir, with_text=True, measure=mf.PROXY_MEASURES))[2]


@register("hashed_features")
def q_hashed_features(spark, sf_dir):
    """Cluster text features: tokenise, stop words, hashed TF (5000), IDF, assemble, scale.

    Rows-only check (vectors): one row per review with the vector size and non-zeros.
    """
    p = mf.proxy_labels(processed(spark, sf_dir, with_text=True, measure=mf.PROXY_MEASURES)).select("review_id", "label", "body", *mf.CLUSTER_NUMERIC_FEATURES)
    _, out = mf.fit_hashed_text_features(p)
    return out.select("review_id", "label", *mf.vector_counts("features"))


@register("vocab_features")
def q_vocab_features(spark, sf_dir):
    """Local text features: uni+bigram counts over a 300-term vocabulary, IDF, L2, + 14 numerics.

    Rows-only check (vectors); ``tfidf_weights`` compares the text part's values.
    """
    _, out = mf.fit_vocab_text_features(features(spark, sf_dir, with_text=True), texts=reviews(spark, sf_dir).select("body"))
    return out.select("review_id", "label", *mf.vector_counts("features"))


def proxy_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mf.proxy_labels(processed(spark, sf_dir)).select("review_id", "label")


@register("oversampled_labels")
def q_oversampled_labels(spark, sf_dir):
    """Cluster trainer's oversampling of the proxy-positive class: Poisson copies by seeded hash."""
    return sm.oversample(reused(proxy_labelled(spark, sf_dir)), cap=5.0, seed=42)


@register("random_split")
def q_random_split(spark, sf_dir):
    """Cluster trainer's 80/20 split."""
    return sm.random_split(proxy_labelled(spark, sf_dir), [0.8, 0.2], seed=42)


@register("cv_folds")
def q_cv_folds(spark, sf_dir):
    return sm.stratified_folds(reused(labelled(spark, sf_dir)), folds=5, seed=42)


@register("reviewer_bursts_ts")
def q_reviewer_bursts_ts(spark, sf_dir):
    return rv.reviewer_bursts_ts(reviews(spark, sf_dir), k=5, hours=24, time_col="scraped_at").select(
        "reviewer_id", "burst_activity")
