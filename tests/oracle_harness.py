"""Run registered queries in Spark and their SQL in DuckDB, and compare.

Comparison: row count, column names, and the multiset of rows with columns
sorted by name. Floats are compared exactly first; ``rel_tol`` reports
near-misses separately. Usage:

    python tests/oracle_harness.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as _dt
import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from veracity.sources.tables import TABLES, table_path  # noqa: E402


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits: int | None):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) if digits is not None else v
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(), digits)
    if hasattr(v, "__int__") and type(v).__name__ == "Decimal":
        return float(v) if digits is None else round(float(v), digits)
    return v


_TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
             "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT", "smallint": "SMALLINT"}


def _types_agree(spark_type: str, duck_type: str) -> bool:
    want = _TYPE_MAP.get(spark_type)
    return want is None or want == duck_type.upper() or (
        spark_type.startswith("array") and duck_type.endswith("[]"))


def rows_multiset(cols: list[str], rows: list, digits: int | None) -> Counter:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i], digits) for i in order) for r in rows)


def compare(spark, sf_dir: str, key: str, query, sql: str, con=None) -> dict:
    con = con or duck_connection(sf_dir)
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_types = {c[0]: str(c[1]) for c in res.description}
    d_rows = res.fetchall()
    t2 = time.time()
    out = {"key": key, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2), "duck_sec": round(t2 - t1, 2),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    s_types = dict(sdf.dtypes)
    bad_types = {c: (s_types[c], d_types.get(c)) for c in s_cols
                 if c in d_types and not _types_agree(s_types[c], d_types[c])}
    if bad_types:
        out["type_mismatch"] = bad_types
    if not out["cols_match"]:
        out["spark_cols"], out["duck_cols"] = sorted(s_cols), sorted(d_cols)
        out["exact"] = out["close"] = False
        return out
    d_rows = [tuple(r[d_cols.index(c)] for c in s_cols) for r in d_rows]
    out["exact"] = rows_multiset(s_cols, s_rows, None) == rows_multiset(s_cols, d_rows, None)
    out["close"] = out["exact"] or (rows_multiset(s_cols, s_rows, 9) == rows_multiset(s_cols, d_rows, 9))
    if not out["close"]:
        a, b = rows_multiset(s_cols, s_rows, 9), rows_multiset(s_cols, d_rows, 9)
        out["only_spark"] = list((a - b).elements())[:3]
        out["only_duck"] = list((b - a).elements())[:3]
        out["cols"] = sorted(s_cols)
    return out


def main(argv: list[str]) -> int:
    from veracity.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as entry
    qs, sqls = entry.queries(), entry.oracle_sql()
    keys = argv[2:] or list(qs)
    spark = local_session()
    con = duck_connection(sf_dir)
    bad = 0
    for k in keys:
        if k not in sqls:
            df = qs[k](spark, sf_dir)
            print({"key": k, "rows_only": df.count(), "cols": df.columns}, flush=True)
            continue
        try:
            r = compare(spark, sf_dir, k, qs[k], sqls[k], con)
        except Exception as e:  # report and continue with the next key
            r = {"key": k, "error": repr(e)[:2000]}
        bad += 0 if r.get("exact") else 1
        print(r, flush=True)
    print(f"mismatched or failed: {bad} of {len(keys)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
