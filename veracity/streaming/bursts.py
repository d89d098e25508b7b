"""Incremental form of the hourly product-burst analysis (Structured Streaming).

The batch operator ``operators.products.hourly_bursts`` counts reviews per
product and hour over a finished table. Here the same counts are kept for a
growing directory of scored reviews: a watermark on ``scraped_at`` bounds
the state (late rows within ``lateness`` still count; older ones are
dropped), and a window is emitted once the watermark passes its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.functions import lexicons as lx
from veracity.functions.numeric import mean6

SCORED_STREAM_SCHEMA = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("product_asin", T.StringType()),
    T.StructField("reviewer_id", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("fake_probability", T.DoubleType()),
    T.StructField("scraped_at", T.TimestampType()),
])


def read_scored_stream(spark: SparkSession, path: str, schema: T.StructType = SCORED_STREAM_SCHEMA,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def hourly_bursts_stream(scored: DataFrame, window_hours: int = 1, threshold: int = 5,
                         lateness: str = "2 hours", fake_at: float = 0.5) -> DataFrame:
    """Windowed product counts with a watermark; rows with count >= threshold."""
    fake = F.coalesce(F.col("fake_probability") >= fake_at, F.lit(False))
    g = (scored.withWatermark("scraped_at", lateness)
         .groupBy(F.coalesce(F.col("product_asin"), F.lit(lx.UNKNOWN_ID)).alias("product_asin"),
                  F.window("scraped_at", f"{int(window_hours)} hours").alias("w"))
         .agg(F.count(F.lit(1)).alias("review_count"), mean6(F.col("rating")).alias("avg_rating"),
              F.count_if(fake).alias("fake_count")))
    return (g.filter(F.col("review_count") >= threshold)
            .select("product_asin", F.date_format("w.start", "yyyy-MM-dd-HH").alias("hour"),
                    "review_count", "avg_rating", "fake_count"))


def start_hourly_bursts(spark: SparkSession, source: str, sink: str, checkpoint: str,
                        window_hours: int = 1, threshold: int = 5, lateness: str = "2 hours",
                        trigger_seconds: int = 60, available_now: bool = False):
    """Run the windowed query from ``source`` into parquet files at ``sink``.

    ``checkpoint`` must be on storage shared by the cluster so the query
    restarts from its state after a failure. Windows are appended once the
    watermark passes their end. ``available_now`` processes what is there
    and stops (windows still open at that point stay in the state).
    """
    q = hourly_bursts_stream(read_scored_stream(spark, source), window_hours, threshold, lateness)
    w = (q.writeStream.outputMode("append").format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
