"""Spark vs DuckDB comparison of the registered queries (used by the tests and by hand).

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return v.item()
    return v


def _key(row):
    return tuple((x is None, "" if x is None else str(x)) for x in row)


def compare(spark, con, name: str, sf_dir: str, query, sql: str) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(v) for v in r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = [tuple(_norm(v) for v in r) for r in rel.fetchall()]
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows), "spark_sec": round(t1 - t0, 2)}
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    d_types = dict(zip(d_cols, (str(t) for t in rel.types)))
    type_diff = {c: (s_types[c], d_types.get(c)) for c in s_types if s_types[c] != d_types.get(c)}
    if type_diff:
        out["type_diff"] = type_diff
    if sorted(s_cols) != sorted(d_cols):
        out["ok"] = False
        out["why"] = f"columns differ: spark={s_cols} oracle={d_cols}"
        return out
    order = [d_cols.index(c) for c in sorted(s_cols)]
    s_order = [s_cols.index(c) for c in sorted(s_cols)]
    s_sorted = sorted((tuple(r[i] for i in s_order) for r in s_rows), key=_key)
    d_sorted = sorted((tuple(r[i] for i in order) for r in d_rows), key=_key)
    out["ok"] = s_sorted == d_sorted and not type_diff
    if type_diff:
        out["why"] = f"column types differ (spark, oracle): {type_diff}"
    elif not out["ok"]:
        diff_s = [r for r in s_sorted if r not in set(d_sorted)][:3]
        diff_d = [r for r in d_sorted if r not in set(s_sorted)][:3]
        out["why"] = f"values differ; cols={sorted(s_cols)} spark-only={diff_s} oracle-only={diff_d}"
    return out


def main(argv):
    from __spark_entry__ import oracle_sql, queries

    from arenaflow.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(queries())
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for n in names:
        if n not in sqls:
            print(f"{n}: no oracle")
            continue
        try:
            r = compare(spark, con, n, sf_dir, qs[n], sqls[n])
        except Exception as exc:  # report and continue
            r = {"name": n, "ok": False, "why": f"{type(exc).__name__}: {str(exc)[:400]}"}
        bad += not r["ok"]
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
