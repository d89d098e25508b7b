"""JSON arrays by byte ranges and CSV files grouped by header, against plain whole-file reads."""

import json
import os
import random

import pytest
from pyspark.sql import types as T

from veracity.sources.arrays import array_records, read_array
from veracity.sources.readers import csv_headers, read_review_array, read_review_csv

NESTED = T.StructType([T.StructField("id", T.StringType()), T.StructField("body", T.StringType()),
                       T.StructField("tags", T.ArrayType(T.StructType([T.StructField("k", T.StringType())])))])


def records(n, rng):
    bits = ["}", "{", '"', "\\", "},{", "\n", ", ", ":", "[", "]", "é", "日", '"}', "\\\\", "plain words "]
    return [{"id": str(k), "body": "".join(rng.choices(bits, k=rng.choice([0, 1, 5, 40]))),
             "tags": [{"k": "".join(rng.choices(bits, k=3))} for _ in range(rng.choice([0, 0, 1, 30]))]}
            for k in range(n)]


@pytest.mark.parametrize("indent", [None, 2])
def test_array_by_byte_ranges(spark, tmp_dir, indent):
    want, rng = [], random.Random(3)
    for k, n in enumerate([60, 1, 0, 30]):
        rows = records(n, rng)
        rows = [{**r, "id": f"{k}/{r['id']}"} for r in rows]
        want += rows
        with open(os.path.join(tmp_dir, f"a{k}.json"), "w") as f:
            json.dump(rows, f, indent=indent, ensure_ascii=bool(k % 2))
    for split in (701, 1 << 20):
        got = read_array(spark, tmp_dir, NESTED, split_bytes=split).collect()
        assert sorted((r.id, r.body, [t.k for t in r.tags]) for r in got) == sorted(
            (w["id"], w["body"], [t["k"] for t in w["tags"]]) for w in want)


def test_record_longer_than_its_splits_and_unended_file(spark, tmp_dir):
    path = os.path.join(tmp_dir, "long.json")
    rows = [{"id": "1", "body": "x" * 5000}, {"id": "2", "body": "}" * 3000}, {"id": "3", "body": "end"}]
    with open(path, "w") as f:
        json.dump(rows, f)
    got = [json.loads(r.json) for r in array_records(spark, path, 211).collect()]
    assert sorted(got, key=lambda r: r["id"]) == rows
    with open(path, "w") as f:
        f.write(json.dumps(rows)[:-40])
    got = read_array(spark, path, NESTED, 512).collect()
    assert sorted(str(r.id) for r in got) == ["1", "None"]               # the cut record is a row of nulls


def test_several_tasks_and_same_rows_as_multiline(spark, tmp_dir):
    path = os.path.join(tmp_dir, "reviews.json")
    with open(path, "w") as f:
        json.dump([{"review_id": f"r{k}", "body": "good } \" { buy " * (k % 7), "rating": k % 5 + 1.0,
                    "verified_purchase": k % 2 == 0, "helpful_votes": k} for k in range(2000)], f, indent=2)
    got = read_review_array(spark, path)
    plain = spark.read.schema(got.schema).option("multiLine", True).json(path)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    small = array_records(spark, path, os.path.getsize(path) // 6)
    assert small.where("json like '%r1999%'").count() == 1
    pieces = next(p for p in small.inputFiles()).rsplit("/", 2)[0]
    assert spark.read.parquet(pieces).select("at").distinct().count() >= 6


def test_one_scan_a_header(spark, tmp_dir):
    rng, want = random.Random(5), []
    heads = [["reviews.text", "reviews.rating"], ["reviews.rating", "asins", ""], ["name", "Name", "two\nlines"]]
    for k in range(60):
        head, rows = heads[k % 3], rng.choice([0, 1, 3])
        quoted = ['"' + h + '"' if "\n" in h else h for h in head]
        with open(os.path.join(tmp_dir, f"f {k} {{x}}[1].csv"), "w", encoding="utf-8-sig" if k % 7 == 0 else "utf-8") as f:
            f.write(",".join(quoted) + "\n")
            for r in range(rows):
                f.write(",".join(f'"v{k}.{r}\n""{c}"""' for c in range(len(head))) + "\n")
        names = {0: heads[0], 1: ["reviews.rating", "asins", "_c2"], 2: ["name0", "Name1", "two\nlines"]}[k % 3]
        want += [{n: f'v{k}.{r}\n"{c}"' for c, n in enumerate(names)} for r in range(rows)]
    open(os.path.join(tmp_dir, "empty.csv"), "w").close()
    groups = csv_headers(spark, [tmp_dir]).collect()
    assert sorted(len(g.files) for g in groups) == [20, 20, 20]
    with pytest.warns(UserWarning, match="nothing"):
        df = read_review_csv(spark, [tmp_dir, os.path.join(tmp_dir, "*.csv"), os.path.join(tmp_dir, "nothing.csv")])
    got = [{k: v for k, v in r.asDict().items() if v is not None} for r in df.collect()]
    assert sorted(map(str, map(sorted, (d.items() for d in got)))) == sorted(map(str, map(sorted, (d.items() for d in want))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 3
    with pytest.raises(ValueError):
        read_review_csv(spark, [os.path.join(tmp_dir, "nothing.csv")])
