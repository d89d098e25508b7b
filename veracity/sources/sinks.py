"""Writers: review tables, CSV exports, table materialisation, snapshots.

Writes go through Spark's committers (a task that is lost and retried
leaves no partial files), and every table is a directory of part files.
Only small exports are coalesced to one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_reviews(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """Processed or raw reviews as JSON Lines (default) or any other format."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Replace a stored collection with ``df`` and return its row count, read back."""
    df.write.mode("overwrite").format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path).count()


def append_table(df: DataFrame, path: str, fmt: str = "parquet", options: dict | None = None) -> None:
    w = df.write.mode("append").format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path)


def append_run(df: DataFrame, path: str, run_id: str, fmt: str = "parquet") -> None:
    """Append the rows of one run, so that running it again leaves one copy.

    The run is a partition (column ``run_id``) and only that partition is replaced; a run without rows
    clears nothing, since it writes to no partition."""
    (df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").format(fmt)
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").save(path))


def save_as_table(df: DataFrame, name: str, if_exists: str = "replace", path: str | None = None) -> None:
    """Materialise a named table: ``replace`` (drop and create) or ``keep`` (create if absent).

    ``path`` places the table's files (an external table); otherwise the warehouse is used.
    """
    mode = {"replace": "overwrite", "keep": "ignore"}[if_exists]
    w = df.write.mode(mode)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header, a file per task; ``single_file`` is for tables that stay small."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def append_summary(processed: DataFrame, path: str, threshold: float = 0.5, fmt: str = "parquet",
                   run_id: str | None = None) -> None:
    """Append one summary row (generated_at, totals, fake %) to a snapshot table; once per ``run_id`` if given."""
    from veracity.operators.reports import overall_summary
    out = overall_summary(processed, threshold).withColumn("generated_at", F.current_timestamp())
    if run_id is not None:
        return append_run(out, path, run_id, fmt)
    out.write.mode("append").format(fmt).save(path)


def append_snapshot(scored: DataFrame, path: str, k: int = 50, fmt: str = "parquet", run_id: str | None = None) -> None:
    """Append one analytics snapshot (all its rows share one generated_at); once per ``run_id`` if given."""
    from veracity.operators.reports import snapshot
    stamp = scored.sparkSession.sql("SELECT current_timestamp() AS t").first()["t"].isoformat()
    out = snapshot(scored, k=k, generated_at=stamp)
    if run_id is not None:
        return append_run(out, path, run_id, fmt)
    out.write.mode("append").format(fmt).save(path)


def save_bucketed(df: DataFrame, name: str, key: str = "reviewer_id", buckets: int = 512,
                  path: str | None = None) -> None:
    """Write a table bucketed and sorted on ``key`` (e.g. reviews by reviewer).

    Later aggregations and joins on ``key`` read the buckets in place instead
    of shuffling. Apply the key defaults before writing so the key has no NULLs.
    """
    w = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
