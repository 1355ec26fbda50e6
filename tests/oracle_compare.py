"""Run registered queries in Spark and their oracle SQL in DuckDB and compare
column names, row counts and order-insensitive values.

    python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v)


def rows_key(rows):
    return sorted((tuple("\x00" if x is None else x for x in r) for r in rows))


def compare(spark, sf_dir, name, fn, sql, con, show=5):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(norm(v) for v in r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(s_rows), spark_s=round(t1 - t0, 2))
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_types = [str(d[1]) for d in cur.description]
    assert not any("DECIMAL" in t.upper() for t in d_types), (name, d_types)
    assert not any(f.dataType.typeName() == "decimal" for f in sdf.schema.fields), (name, sdf.schema)
    d_rows = [tuple(norm(v) for v in r) for r in cur.fetchall()]
    t2 = time.time()
    res = dict(name=name, rows=len(s_rows), oracle_rows=len(d_rows),
               spark_s=round(t1 - t0, 2), duck_s=round(t2 - t1, 2))
    if sorted(s_cols) != sorted(d_cols):
        res.update(ok=False, why=f"columns {s_cols} vs {d_cols}")
        return res
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_idx = {c: i for i, c in enumerate(d_cols)}
    s_sorted = rows_key([tuple(r[i] for i in order) for r in s_rows])
    d_sorted = rows_key([tuple(r[d_idx[s_cols[i]]] for i in order) for r in d_rows])
    ok = s_sorted == d_sorted
    res["ok"] = ok
    if not ok:
        s_set, d_set = set(s_sorted), set(d_sorted)
        res["spark_only"] = [x for x in s_sorted if x not in d_set][:show]
        res["oracle_only"] = [x for x in d_sorted if x not in s_set][:show]
        res["cols"] = [s_cols[i] for i in order]
    return res


def main():
    from rewardflow.session import build_session
    import __spark_entry__ as E
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(E.queries())
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, qs[n], sqls.get(n), con)
        except Exception as e:  # report and go on
            r = dict(name=n, ok=False, why=f"{type(e).__name__}: {str(e)[:400]}")
        bad += r.get("ok") is False
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
