"""Readers and writers: round trips and malformed input."""

import json
import os

from veracity.sources.readers import (read_declared_table, read_review_array, read_review_csv,
                                      read_review_lines)
from veracity.sources.sinks import export_csv, replace_table, save_as_table, write_reviews


def test_json_array_and_lines(spark, tmp_dir):
    recs = [{"review_id": "a", "body": "hello", "rating": 5.0, "date": "x"},
            {"review_id": "b", "body": "bye", "rating": 1.0}]
    arr = os.path.join(tmp_dir, "arr.json")
    with open(arr, "w") as f:
        json.dump(recs, f, indent=2)
    assert sorted(r.review_id for r in read_review_array(spark, arr).collect()) == ["a", "b"]
    lines = os.path.join(tmp_dir, "lines.json")
    with open(lines, "w") as f:
        f.write(json.dumps(recs[0]) + "\n\n{broken\n" + json.dumps(recs[1]) + "\n")
    got = read_review_lines(spark, lines).collect()
    assert sorted(r.review_id for r in got) == ["a", "b"]
    declared = read_declared_table(spark, lines, view="raw_reviews_test")
    assert "review_date" in declared.columns
    assert spark.sql("SELECT count(*) FROM raw_reviews_test").first()[0] == 2


def test_csv_dotted_header_multiline(spark, tmp_dir):
    p1 = os.path.join(tmp_dir, "a.csv")
    with open(p1, "w") as f:
        f.write('reviews.text,reviews.rating\n"line one\nline two",5\nplain,3\n')
    p2 = os.path.join(tmp_dir, "b.csv")
    with open(p2, "w") as f:
        f.write('reviews.rating,asins\n4,B1\n')
    df = read_review_csv(spark, [p1, p2, p1, os.path.join(tmp_dir, "missing.csv")])
    rows = df.collect()
    assert len(rows) == 3   # two rows of a.csv (read once), one of b.csv; the missing file is skipped
    assert "asins" in df.columns and "reviews.text" in df.columns
    assert any(r["reviews.text"] == "line one\nline two" for r in rows)


def test_writers(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "review_id string, rating double")
    out = os.path.join(tmp_dir, "w")
    write_reviews(df, out)
    assert spark.read.json(out).count() == 2
    assert replace_table(df, os.path.join(tmp_dir, "t")) == 2
    assert replace_table(df.limit(1), os.path.join(tmp_dir, "t")) == 1
    export_csv(df, os.path.join(tmp_dir, "c"), single_file=True)
    assert len([f for f in os.listdir(os.path.join(tmp_dir, "c")) if f.endswith(".csv")]) == 1


def test_save_as_table_modes(spark, tmp_dir):
    a = spark.createDataFrame([("a",)], "k string")
    b = spark.createDataFrame([("b",), ("c",)], "k string")
    path = os.path.join(tmp_dir, "tbl")
    save_as_table(a, "veracity_ctas_test", "replace", path=path)
    save_as_table(b, "veracity_ctas_test", "keep", path=path)       # exists: kept as is
    assert spark.table("veracity_ctas_test").count() == 1
    save_as_table(b, "veracity_ctas_test", "replace", path=path)    # drop and create
    assert spark.table("veracity_ctas_test").count() == 2
    spark.sql("DROP TABLE veracity_ctas_test")
