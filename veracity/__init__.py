"""veracity: review-integrity analytics on Spark.

Every operator is a function from DataFrame(s) to a DataFrame; sessions and
I/O stay at the edges (``veracity.session``, ``veracity.sources``).
"""

from veracity.ml.evaluate import (best_model, classifier_metrics, confusion_matrix,
                                  feature_importances, roc_curve)
from veracity.ml.features import (feature_table, hashed_text_pipeline, proxy_labels, term_doc_freq,
                                  vocab_text_pipeline)
from veracity.ml.score import load_model, save_model, score_reviews, write_scored
from veracity.ml.train import train_gbt_cv, train_models
from veracity.operators.normalise import normalise_reviews, parse_review_dates
from veracity.operators.products import (daily_review_bursts, hourly_bursts, product_fraud_summary,
                                         rating_deviation, review_sentiments)
from veracity.operators.reports import (class_balance, feature_preview, overall_summary,
                                        rating_distribution, snapshot, top_suspicious_reviews)
from veracity.operators.reviewers import (burst_reviewers, fraud_scores, reviewer_bursts, reviewer_flags,
                                          reviewer_frequency, reviewer_report, suspicious_reviewers)
from veracity.operators.sampling import (balance_exact, label_noise, oversample, sample_reviews,
                                         stratified_split)
from veracity.operators.signals import lexicon_signals, review_signals, weak_labels
from veracity.sources.pages import extract_page_records
from veracity.sources.readers import read_review_array, read_review_csv, read_review_lines
from veracity.sources.sinks import (append_snapshot, append_summary, export_csv, replace_table,
                                    save_as_table, save_bucketed, write_reviews)

__all__ = [
    "read_review_csv", "read_review_array", "read_review_lines",
    "normalise_reviews", "sample_reviews", "parse_review_dates",
    "review_signals", "lexicon_signals", "weak_labels",
    "reviewer_bursts", "reviewer_flags", "fraud_scores",
    "review_sentiments", "suspicious_reviewers", "product_fraud_summary", "daily_review_bursts",
    "reviewer_frequency", "hourly_bursts", "rating_deviation",
    "overall_summary", "reviewer_report", "burst_reviewers", "rating_distribution", "class_balance",
    "top_suspicious_reviews", "feature_preview",
    "snapshot", "write_reviews", "write_scored", "export_csv", "replace_table", "save_as_table",
    "save_bucketed", "append_snapshot", "append_summary",
    "extract_page_records",
    "hashed_text_pipeline", "vocab_text_pipeline", "feature_table", "term_doc_freq",
    "proxy_labels", "label_noise", "oversample", "balance_exact", "stratified_split",
    "train_gbt_cv", "train_models", "score_reviews", "save_model", "load_model",
    "classifier_metrics", "confusion_matrix", "roc_curve", "best_model", "feature_importances",
]
