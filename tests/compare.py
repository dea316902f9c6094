"""Spark-vs-DuckDB comparison of registered queries (the correctness gate).

Usage: python -m tests.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return repr(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(str(_norm(r[i])) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def spark_type(t) -> str:
    n = t.simpleString()
    return {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
            "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "smallint": "SMALLINT",
            "float": "FLOAT"}.get(n, n.upper())


def compare(spark, con, name, query, sf_dir, verbose=True):
    t0 = time.time()
    df = query.build(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if query.sql is None:
        return {"name": name, "rows": len(s_rows), "oracle": False, "ok": None, "sec": t1 - t0}
    rel = con.sql(query.sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    s_types = {f.name: spark_type(f.dataType) for f in df.schema.fields}
    d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
    type_diff = {c: (s_types.get(c), d_types.get(c)) for c in s_types if s_types.get(c) != d_types.get(c)}
    hs, ls = digest(s_cols, s_rows)
    hd, ld = digest(d_cols, d_rows)
    ok = ok_cols and len(s_rows) == len(d_rows) and hs == hd
    res = {"name": name, "rows": len(s_rows), "oracle_rows": len(d_rows), "cols_ok": ok_cols,
           "ok": ok, "sec": round(t1 - t0, 2)}
    if type_diff:
        res["types"] = type_diff
    if not ok and verbose:
        print("  spark cols", s_cols, "\n  duck cols ", d_cols)
        a, b = set(ls), set(ld)
        print("  only spark:", sorted(a - b)[:5])
        print("  only duck: ", sorted(b - a)[:5])
    return res


def main(argv):
    sys.path.insert(0, ".")
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    from strata.catalog import load_all
    from strata.session import build_session
    reg = load_all()
    spark = build_session("compare")
    con = duck(sf_dir)
    bad = 0
    for name, q in reg.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, q, sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "ok": False, "error": str(e)[:400]}
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print("FAILED", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
