"""Report tables: overall summary, distributions, top-k lists and the snapshot.

Top-k lists are the feature here (the report shows the top 5 / 50), so they
keep a ``limit``; every ordering ends in a key column so ties are stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracity.functions.numeric import round6, scaled_round, tenths_threshold
from veracity.operators.products import hourly_bursts, rating_deviation
from veracity.operators.reviewers import reviewer_frequency


def overall_summary(processed: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row: total, fake (score >= threshold), genuine, spam, fake % (2 dp), reviewers."""
    t = tenths_threshold(threshold)
    n = F.count(F.lit(1))
    fake = F.count_if(F.col("score_tenths") >= t)
    return processed.agg(
        n.alias("total_reviews"),
        fake.alias("fake_reviews"),
        F.count_if(F.col("score_tenths") < t).alias("genuine_reviews"),
        F.count_if(F.col("spam_flag")).alias("spam_flagged"),
        scaled_round(fake * 100, F.greatest(n, F.lit(1)), 2).alias("fake_percentage"),
        F.count_distinct("reviewer_id").alias("distinct_reviewers"),
    )


def rating_distribution(labelled: DataFrame) -> DataFrame:
    """Reviews per whole star, with the overall mean rating and label counts."""
    # One pass over the reviews; the overall figures are sums over the few star rows.
    per_star = labelled.groupBy(F.floor("rating").cast("int").alias("star")).agg(
        F.count(F.lit(1)).alias("review_count"), F.sum("rating").alias("_sum"), F.count("rating").alias("_n"),
        F.count_if(F.col("is_fake_ground_truth") == 1).alias("_fake"),
        F.count_if(F.col("is_fake_ground_truth") == 0).alias("_genuine"))
    every = Window.partitionBy()
    return per_star.select(
        "star", "review_count",
        scaled_round(F.sum("_sum").over(every), F.sum("_n").over(every), 2).alias("overall_avg_rating"),
        F.sum("_fake").over(every).alias("fake_labels"),
        F.sum("_genuine").over(every).alias("genuine_labels")).orderBy(F.col("star").desc())


def table_heads(tables: dict[str, DataFrame], n: int = 10) -> dict[str, DataFrame]:
    """The first ``n`` rows of each summary table, in its own order (what the run prints)."""
    return {name: df.limit(n) for name, df in tables.items()}


def class_balance(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows per class, one pass (the original counted each class with its own scan)."""
    return df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n")).orderBy("label")


def top_suspicious_reviews(processed: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` reviews with the highest fraud score, with their flags and body."""
    return (processed.orderBy(F.col("score_tenths").desc(), F.col("review_id"))
            .limit(n)
            .select("review_id", "reviewer_id", "product_asin", "rating",
                    "reviewer_fraud_score", "spam_flag", "word_count",
                    F.bround("caps_ratio", 4).alias("caps_ratio"), "exclamation_count",
                    F.col("reviewer_flags.burst_activity").alias("burst_activity"),
                    F.col("reviewer_flags.all_extreme_ratings").alias("all_extreme_ratings"),
                    F.col("reviewer_flags.unverified_ratio").alias("unverified_ratio"),
                    F.col("reviewer_flags.total_reviews").alias("total_reviews"),
                    "body"))


def feature_preview(processed: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` reviews by review_id with their signals and verdict."""
    return (processed.orderBy("review_id").limit(n)
            .select("review_id", "body", "word_count", F.bround("caps_ratio", 3).alias("caps_ratio"),
                    "exclamation_count", "has_url", "spam_flag", "reviewer_fraud_score", "verdict"))


def snapshot_sections(scored: DataFrame, k: int = 50, threshold: int = 5) -> dict[str, DataFrame]:
    """The three analyses of an analytics snapshot, as separate tables.

    ``reviewer_frequency`` and ``rating_deviations`` keep their top ``k``;
    ``burst_events`` keeps all rows. Kept as tables (not arrays inside one
    row), because the burst list grows with the data.
    """
    return {
        "reviewer_frequency": reviewer_frequency(scored).limit(k),
        "burst_events": hourly_bursts(scored, threshold=threshold),
        "rating_deviations": rating_deviation(scored).limit(k),
    }


def snapshot(scored: DataFrame, k: int = 50, threshold: int = 5,
             generated_at: str | None = None) -> DataFrame:
    """One long table with every snapshot row: section, key, metric, count, and every column of the three
    analyses (null in the sections that lack it).

    ``generated_at`` (ISO text) stamps every row of one snapshot; by default
    the query's current timestamp.
    """
    s = snapshot_sections(scored, k=k, threshold=threshold)
    stamp = F.lit(generated_at).cast("timestamp") if generated_at else F.current_timestamp()

    def rows(section: str, key, metric: str, count: str) -> DataFrame:
        return s[section].select(F.lit(section).alias("section"), key.alias("item_key"),
                                 F.col(metric).cast("double").alias("metric"),
                                 F.col(count).cast("long").alias("item_count"), "*")

    freq = rows("reviewer_frequency", F.col("reviewer_id"), "fake_ratio", "total_reviews")
    bursts = rows("burst_events", F.concat_ws("|", "product_asin", "hour"), "avg_rating", "review_count")
    dev = rows("rating_deviations", F.col("product_asin"), "rating_inflation", "total_reviews")
    return (freq.unionByName(bursts, allowMissingColumns=True).unionByName(dev, allowMissingColumns=True)
            .withColumn("generated_at", stamp))


__all__ = ["overall_summary", "rating_distribution", "class_balance", "top_suspicious_reviews",
           "feature_preview", "table_heads", "snapshot_sections", "snapshot", "round6"]
