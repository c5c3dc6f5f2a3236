"""Run registered queries against their DuckDB oracles, like the driver does.

    python tests/oracle_check.py [sf_dir] [key ...]

Prints one line per key: rows (spark/oracle), column names match, and
whether the order-insensitive value multisets are equal.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    import __spark_entry__ as E
    from folia.session import get_session

    spark = get_session("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    con = connect(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as exc:  # report and go on
            print(f"{name:22s} SPARK ERROR {str(exc)[:300]}")
            bad += 1
            continue
        st = time.time() - t
        if name not in sqls:
            print(f"{name:22s} spark={len(srows)} (no oracle) {st:.1f}s")
            continue
        try:
            res = con.execute(sqls[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as exc:
            print(f"{name:22s} ORACLE ERROR {str(exc)[:300]}")
            bad += 1
            continue
        same_cols = sorted(scols) == sorted(ocols)
        a, b = _rows(scols, srows), _rows(ocols, orows)
        ok = same_cols and a == b
        bad += not ok
        print(f"{name:22s} {'OK ' if ok else 'BAD'} spark={len(srows)} oracle={len(orows)} cols={'=' if same_cols else (scols, ocols)} {st:.1f}s")
        if not ok and same_cols:
            sa, sb = set(a), set(b)
            for r in list(sa - sb)[:2]:
                print("   spark-only ", repr(r)[:400])
            for r in list(sb - sa)[:2]:
                print("   oracle-only", repr(r)[:400])
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
