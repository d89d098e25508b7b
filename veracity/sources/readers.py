"""Readers for review dumps: CSV exports, a JSON array, JSON Lines, a declared table.

Schemas are explicit wherever the layout is known, so reads never infer
types from a sample and malformed input cannot change the schema.
"""

from __future__ import annotations

import csv
import re
import warnings
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.sources.arrays import fixed_splits, read_array

RAW_REVIEW = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("product_asin", T.StringType()),
    T.StructField("reviewer_id", T.StringType()),
    T.StructField("reviewer_name", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("title", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("verified_purchase", T.BooleanType()),
    T.StructField("helpful_votes", T.IntegerType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("scraped_at", T.StringType()),
    T.StructField("is_fake_ground_truth", T.IntegerType()),
])

REVIEWER_FLAGS = T.StructType([
    T.StructField("total_reviews", T.IntegerType()),
    T.StructField("avg_rating", T.DoubleType()),
    T.StructField("rating_std", T.DoubleType()),
    T.StructField("all_extreme_ratings", T.BooleanType()),
    T.StructField("burst_activity", T.BooleanType()),
    T.StructField("unverified_ratio", T.DoubleType()),
])

PROCESSED_REVIEW = T.StructType(RAW_REVIEW.fields + [
    T.StructField("spam_flag", T.BooleanType()),
    T.StructField("word_count", T.IntegerType()),
    T.StructField("has_url", T.BooleanType()),
    T.StructField("exclamation_count", T.IntegerType()),
    T.StructField("caps_ratio", T.DoubleType()),
    T.StructField("reviewer_flags", REVIEWER_FLAGS),
    T.StructField("reviewer_fraud_score", T.DoubleType()),
])

# The declared SQL table over the scoring output (15 columns); its
# ``review_date`` is the JSON field ``date``.
DECLARED_TABLE = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("product_asin", T.StringType()),
    T.StructField("reviewer_id", T.StringType()),
    T.StructField("reviewer_name", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("title", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("verified_purchase", T.BooleanType()),
    T.StructField("helpful_votes", T.IntegerType()),
    T.StructField("spam_flag", T.BooleanType()),
    T.StructField("word_count", T.IntegerType()),
    T.StructField("caps_ratio", T.DoubleType()),
    T.StructField("exclamation_count", T.IntegerType()),
    T.StructField("reviewer_fraud_score", T.DoubleType()),
])


def read_review_csv(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Read CSV exports with a header and stack them by column name.

    One job reads the first record of every file; files are grouped by header, and each header is one
    scan with a declared schema, however many files have it. Overlapping globs give a file once; columns
    missing from a file become NULL. All values are read as strings; quoted fields may span lines. A
    path that cannot be found is skipped with a warning, an empty file has no rows; if no file has a
    header, the read fails.
    """
    unique = list(dict.fromkeys(paths))
    out = None
    for group in sorted(csv_headers(spark, unique).collect()):          # one row a header
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header_names(group["header"])])
        df = (spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
              .option("mode", "PERMISSIVE").csv([_GLOB.sub(r"\\\g<0>", f) for f in map(unquote, group["files"])]))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no readable CSV among {unique}")
    return out


HEADER_LINES = 1024
_GLOB = re.compile(r"[\\{}\[\]*?]")


def csv_headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``header, files``: the files under ``paths`` by their first record. A task opens one file and
    stops after its first lines (a header record of up to HEADER_LINES lines is seen whole)."""
    probe = fixed_splits(spark, 1 << 40)                                 # a file a task
    probe.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(HEADER_LINES))
    lines = _text_of(probe, paths)
    if lines is None:
        return spark.createDataFrame([], "header array<string>, files array<string>")
    return (lines.select("_metadata.file_path", "_metadata.file_block_start", "value")
            .mapInArrow(_first_record, "file string, header array<string>")
            .groupBy("header").agg(F.sort_array(F.collect_set("file")).alias("files")))


def header_names(header: list[str]) -> list[str]:
    """Column names of a header record: an unnamed column is called by its place, and names that
    repeat (in any case) get their place appended."""
    low = [c.lower() for c in header]
    return [f"_c{k}" if not c else f"{c}{k}" if low.count(low[k]) > 1 else c for k, c in enumerate(header)]


def _text_of(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """The lines of all paths that exist, with a warning for each that does not."""
    left = list(paths)
    while left:
        try:
            return spark.read.text(left)
        except AnalysisException as e:
            lost = (e.getMessageParameters() or {}).get("path", "")
            gone = [p for p in left if lost.endswith(p.split(":", 1)[-1].lstrip("/"))]
            if e.getCondition() != "PATH_NOT_FOUND" or not gone:
                raise
            warnings.warn(f"skipping unreadable CSV {gone[0]}: {e}")
            left.remove(gone[0])
    return None


def _first_record(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows or b.column(1)[0].as_py():                     # of a cut file, the first split alone
            return
        lines = [line or "" for line in b.column(2).to_pylist()]
        lines[0] = lines[0].removeprefix("\ufeff")
        record = next((r for r in csv.reader(line + "\n" for line in lines) if r), None)
        if record:
            yield pa.RecordBatch.from_arrays([pa.array([b.column(0)[0].as_py()]), pa.array([record], pa.list_(pa.string()))],
                                             ["file", "header"])
        if b.num_rows < HEADER_LINES:
            next(batches, None)                                          # read to its end, the worker is used again
        return                                                           # the rest of a longer file stays unread


def read_review_array(spark: SparkSession, path: str, schema: T.StructType = RAW_REVIEW) -> DataFrame:
    """Files holding one JSON array of review objects each (indented or not), read by byte ranges."""
    return read_array(spark, path, schema)


def read_review_lines(spark: SparkSession, path: str, schema: T.StructType = PROCESSED_REVIEW) -> DataFrame:
    """JSON Lines in a declared schema; blank and broken lines are left out (see ``read_broken_lines``).

    Values are read as text and then cast, so a value of another JSON type ("5.0", 3.0 for an
    integer) is kept wherever it can be converted, and is null (not a lost row) where it cannot.
    """
    raw = _lines_as_text(spark, path, schema)
    first = schema.fields[0].name
    # The second condition keeps a data column in the filter: Spark must parse to judge a line.
    kept = raw.where(F.col(BROKEN).isNull() & (F.col(first).isNull() | F.col(first).isNotNull()))
    return kept.select(*[_declared(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def read_broken_lines(spark: SparkSession, path: str, schema: T.StructType = PROCESSED_REVIEW) -> DataFrame:
    """The lines that are no JSON object, as they stand: one column ``line``."""
    raw = _lines_as_text(spark, path, schema)
    first = schema.fields[0].name
    return raw.where(F.col(BROKEN).isNotNull() & (F.col(first).isNull() | F.col(first).isNotNull())).select(
        F.col(BROKEN).alias("line"))


BROKEN = "_broken_line"


def _textual(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _textual(f.dataType)) for f in kind.fields])
    return T.StringType()


def _declared(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        inner = F.struct(*[_declared(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(value.isNotNull(), inner)
    if isinstance(kind, T.IntegerType):
        return value.try_cast("double").try_cast("int")
    return value if isinstance(kind, T.StringType) else value.try_cast(kind)


def _lines_as_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    text = T.StructType([*_textual(schema).fields, T.StructField(BROKEN, T.StringType())])
    return (spark.read.schema(text).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", BROKEN).json(path))


def read_declared_table(spark: SparkSession, path: str, view: str | None = "raw_reviews") -> DataFrame:
    """The declared 15-column table over JSON Lines, with ``review_date`` from ``date``.

    Registered as a temporary view when ``view`` is given.
    """
    df = read_review_lines(spark, path, DECLARED_TABLE).withColumnRenamed("date", "review_date")
    if view:
        df.createOrReplaceTempView(view)
    return df
