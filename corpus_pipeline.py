"""A training-data pipeline over ``documents``: five of the operators of ``veracity.llm`` in a row.

Each stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor kept and returns a
DataFrame; all but the last return the columns of ``docs``. Rows are told apart by id and text, so
an id that repeats with another text is a document of its own; a row that repeats in full is one
document and leaves the near-duplicate stage once.

1. language_id: documents without a letter (``und``) or without any language that the network
   gives at least ``MIN_LANGUAGE_SCORE`` go; all others stay.
2. line_dedup: lines equal to an earlier line, or one word edit away from one, are taken out of the
   texts. A document that had words and loses all of its lines goes; ``n_chars`` follows the text.
3. near_duplicates: of each group connected by 5-word shingle similarity of 0.8 or more, the
   document with the smallest id stays.
4. decontamination: documents with a twentieth of their words inside benchmark windows go.
5. packing: what is left as pieces of token windows.

Empty tables pass through; null text has no letter and goes in the first stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.llm.decontam import benchmark_hits, contaminated
from veracity.llm.jaccard import jaccard_groups
from veracity.llm.langid import UNKNOWN, identify_languages
from veracity.llm.line_dedup import dedup_lines
from veracity.llm.queries import packed
from veracity.session import ensure_checkpoint_dir
from veracity.sources.tables import read_table

#: Less than what clean short texts get; a text that fits no learned language falls below.
MIN_LANGUAGE_SCORE = 0.35

#: Chunks that a packing worker remembers here: its executor still holds what the stages before it needed.
PACKING_MEMO_BYTES = 32 << 20


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with neutral column names, which no operator's own columns can clash with."""
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, c = _numbered(docs)
    rest = tuple(v for k, v in c.items() if k != "doc_id")
    out = identify_languages(rows, c["doc_id"], c["text"], c["lang"], keep=rest)
    kept = out.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return kept.select(*[F.col(v).alias(k) for k, v in c.items()])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, c = _numbered(docs)
    out = dedup_lines(rows, c["doc_id"], c["text"], n_dropped_col="dropped")
    some = F.coalesce(F.col(c["text"]), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    out = out.where(some | (F.col("dropped") == 0))
    if "n_chars" in c:
        out = out.withColumn(c["n_chars"], F.length(c["text"]).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(v).alias(k) for k, v in c.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, c = _numbered(docs)
    rows = rows.withColumn("rid", F.struct(F.col(c["doc_id"]).alias("id"), F.xxhash64(c["text"]).alias("th")))
    groups = jaccard_groups(rows, "rid", c["text"])
    gone = groups.where(~F.col("rid").eqNullSafe(F.col("component_id"))).select("rid").distinct()
    out = rows.join(gone, "rid", "left_anti")
    if groups.count() > groups.select("rid").distinct().count():         # rows that repeat in full
        out = out.dropDuplicates(["rid"])
    return out.select(*[F.col(v).alias(k) for k, v in c.items()])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, c = _numbered(docs)
    rest = tuple(v for k, v in c.items() if k != "doc_id")
    out = benchmark_hits(rows, read_table(spark, sf_dir, "benchmark"), c["doc_id"], c["text"], keep=rest)
    return out.where(~contaminated()).select(*[F.col(v).alias(k) for k, v in c.items()])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs, memo_bytes=PACKING_MEMO_BYTES)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: A trained network decides the first stage: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared checkpoint folder
    and read again, so a stage's several passes do not repeat the ones before it."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
