"""The pipeline stage by stage, and the registered queries against DuckDB."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from veracity.llm.queries import ORACLE, QUERIES

from .conftest import DOC
from .test_dedup import brute_groups, brute_lines
from .test_text_ops import brute_hits

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(QUERIES, key=lambda q: int(q[2:].split("_")[0])) and {
        int(q[2:].split("_")[0]) for q in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_oracle(spark, key):
    from oracle_harness import compare
    r = compare(spark, SF, key, QUERIES[key], ORACLE[key])
    assert r.get("exact"), r


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, None, "s", 0), (9002, "12 34 !!", None, "s", 8), (9003, "", "en", "s", 0)],
                                  docs.schema)
    docs = docs.unionByName(extra).withColumn("lang_pred", F.lit("mine")).withColumn("spans", F.lit(1))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    kept = P.language_id(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(rows_of(kept)) == sorted(rows_of(docs.where("doc_id < 9000")))

    lines = P.line_dedup(spark, kept, SF)
    assert lines.columns == docs.columns
    want = {d: t for (d, _), t in brute_lines(rows_of(kept)).items() if t.strip()}
    assert dict(rows_of(lines)) == want
    assert lines.where("n_chars <> length(text)").count() == 0

    single = P.near_duplicates(spark, kept, SF)
    assert single.columns == docs.columns
    assert sorted(d for d, _ in rows_of(single)) == sorted(d for d, _, c in brute_groups(rows_of(kept)) if d == c)

    clean = P.decontamination(spark, kept, SF)
    assert clean.columns == docs.columns
    assert sorted(d for d, _ in rows_of(clean)) == sorted(d for d, t in rows_of(kept) if not brute_hits(t, items)[3])

    pieces = P.packing(spark, kept, SF)
    assert pieces.agg(F.sum("length")).first()[0] == pieces.dropDuplicates(["doc_id"]).agg(F.sum("doc_tokens")).first()[0]


def test_run_and_empty(spark):
    out = P.run(spark, SF)
    assert out.count() > 0 and "ids_crc32" in out.columns and len(P.STAGES) == 5
    docs = spark.createDataFrame([], DOC)
    for name, stage in P.STAGES:
        assert stage(spark, docs, SF).count() == 0, name


def test_repeated_rows_leave_once(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(1, text), (1, text), (2, text), (1, "a different text of the same id here"), (None, text)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(rows_of(P.near_duplicates(spark, df, SF)), key=str)
    assert len([r for r in got if r[1] == text]) == 1 and (1, rows[3][1]) in got


def test_rest_works_without_this_subpackage(tmp_path):
    """The entry and the library import when the subpackage, its tests and the pipeline are gone."""
    root = os.path.dirname(os.path.abspath(P.__file__))
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name.startswith('veracity.llm') or name == 'corpus_pipeline':\n"
            "            raise ImportError(name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert len(e.queries()) > 40 and not any(q.startswith('op') and q[2].isdigit() for q in e.queries())\n")
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_batches_are_bounded_by_bytes(spark):
    """Long texts reach a worker a few MB at a time, whatever their number; no row is lost."""
    import pyarrow as pa

    from veracity.llm.common import BATCH_BYTES, map_arrow

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    rows = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('x', if(id < 2000, 8000, 10)) AS t")
    out = map_arrow(rows, sizes, "n long, size long").collect()
    assert sum(r["n"] for r in out) == 3000
    assert max(r["size"] for r in out) < BATCH_BYTES + 16000
