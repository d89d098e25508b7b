"""End-to-end jobs: the pipeline's entry points as Spark applications.

    python -m veracity.plans.jobs score     --input raw.json --output processed/ [--array]
    python -m veracity.plans.jobs summaries --input processed/ --output out/ [--preset hql|word]
    python -m veracity.plans.jobs snapshot  --input scored/ --output snapshots/
    python -m veracity.plans.jobs train     --input processed/ --output model/ [--trainer local|cluster]
    python -m veracity.plans.jobs predict   --model model/ --input processed/ --output scored/
    python -m veracity.plans.jobs bursts-stream --input scored_dir/ --output bursts/ --checkpoint shared_dir/

Each job reads, runs the operators and writes once; outputs are directories
written through Spark's committers, so a retried task leaves nothing behind.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.ml import score as sc
from veracity.ml import train as tr
from veracity.ml.features import feature_table, proxy_labels
from veracity.operators import products as pr
from veracity.operators import reviewers as rv
from veracity.operators.signals import lexicon_signals
from veracity.sources import readers as rd
from veracity.sources import sinks as sk


def score_job(spark: SparkSession, input_path: str, output_path: str, array: bool = False) -> DataFrame:
    """Raw reviews (JSON array or JSON Lines) -> processed reviews (JSON Lines)."""
    raw = rd.read_review_array(spark, input_path) if array else rd.read_review_lines(spark, input_path, rd.RAW_REVIEW)
    processed = rv.fraud_scores(raw).drop("score_tenths", "verdict")
    sk.write_reviews(processed, output_path, fmt="json")
    return spark.read.schema(rd.PROCESSED_REVIEW).json(output_path)


def summaries_job(spark: SparkSession, processed_path: str, out_dir: str, preset: str = "hql") -> dict:
    """Sentiment table + suspicious reviewers, product summary, daily bursts (parquet and CSV)."""
    processed = rd.read_review_lines(spark, processed_path)
    processed = processed.withColumn("score_tenths", F.round(F.col("reviewer_fraud_score") * 10).cast("int"))
    if preset == "hql":
        sent = pr.review_sentiments(lexicon_signals(processed, "hql"), min_body_length=10, preset="hql")
        tables = {"suspicious_reviewers": rv.suspicious_reviewers(sent, min_reviews=4),
                  "product_fraud_summary": pr.product_fraud_summary(sent, with_stddev=True),
                  "daily_review_bursts": pr.daily_review_bursts(sent, min_count=11, day="raw")}
    else:
        sent = pr.review_sentiments(lexicon_signals(processed, "word"), min_body_length=None, preset="word")
        tables = {"suspicious_reviewers": rv.suspicious_reviewers(sent, min_reviews=2,
                                                                  mismatch_col="mismatch_count"),
                  "product_fraud_summary": pr.product_fraud_summary(sent, with_stddev=False),
                  "daily_review_bursts": pr.daily_review_bursts(sent, min_count=3, day="clean")}
    sent.drop("score_tenths").write.mode("overwrite").parquet(os.path.join(out_dir, "review_sentiments"))
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(os.path.join(out_dir, name))
        sk.export_csv(spark.read.parquet(os.path.join(out_dir, name)), os.path.join(out_dir, name + "_csv"))
    return {name: spark.read.parquet(os.path.join(out_dir, name)) for name in tables}


def snapshot_job(spark: SparkSession, scored_path: str, snapshot_path: str, k: int = 50) -> None:
    """Append one analytics snapshot computed from scored reviews (parquet)."""
    sk.append_snapshot(spark.read.parquet(scored_path), snapshot_path, k=k)


def train_job(spark: SparkSession, processed_path: str, model_path: str, trainer: str = "local") -> DataFrame:
    """Fit the local (GBT + RF, best by AUC) or cluster (GBT grid search) model; save it."""
    processed = rd.read_review_lines(spark, processed_path)
    if trainer == "cluster":
        model, metrics = tr.train_gbt_cv(processed)
    else:
        from veracity.ml.evaluate import best_model
        fitted, metrics = tr.train_models(feature_table(processed))
        metrics = metrics.cache()
        model = fitted[best_model(metrics).first()["model"]]
    sc.save_model(model, model_path)
    return metrics


def predict_job(spark: SparkSession, model_path: str, input_path: str, target: str, fmt: str = "parquet",
                trainer: str = "local") -> None:
    """Score processed reviews with a saved model and append them to ``target``."""
    processed = rd.read_review_lines(spark, input_path)
    # Every column the result needs travels with its row: no join back, so repeated or
    # missing ids neither multiply nor lose rows. The cluster form derives the features
    # that the stored reviews lack, as training does.
    df = (feature_table(processed, carry=("product_asin", "reviewer_id", "scraped_at"))
          if trainer == "local" else proxy_labels(processed))
    sc.write_scored(sc.score_reviews(df, model_path), target, fmt=fmt)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="veracity.plans.jobs")
    ap.add_argument("job", choices=["score", "summaries", "snapshot", "train", "predict", "bursts-stream"])
    ap.add_argument("--checkpoint", help="shared folder for the streaming query's state")
    ap.add_argument("--input", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--model")
    ap.add_argument("--array", action="store_true")
    ap.add_argument("--preset", default="hql")
    ap.add_argument("--trainer", default="local")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"veracity-{a.job}").getOrCreate()
    if a.job == "score":
        score_job(spark, a.input, a.output, a.array)
    elif a.job == "summaries":
        summaries_job(spark, a.input, a.output, a.preset)
    elif a.job == "snapshot":
        snapshot_job(spark, a.input, a.output)
    elif a.job == "train":
        train_job(spark, a.input, a.output, a.trainer).show(truncate=False)
    elif a.job == "predict":
        predict_job(spark, a.model, a.input, a.output, trainer=a.trainer)
    else:
        from veracity.streaming.bursts import start_hourly_bursts
        if not a.checkpoint:
            ap.error("bursts-stream needs --checkpoint on shared storage")
        start_hourly_bursts(spark, a.input, a.output, a.checkpoint).awaitTermination()


if __name__ == "__main__":
    main()
