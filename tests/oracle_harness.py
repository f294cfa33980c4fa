"""Run registered queries against their DuckDB oracle (as the driver does).

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lendlens.sources.tables import TABLES  # noqa: E402


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
            return None
        v = round(v, 6)
        return 0.0 if v == 0 else v
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} duck={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    return problems, t1 - t0


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from lendlens.session import get_spark
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_spark()
    con = duck(sf_dir)
    qs, os_ = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in os_:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"ROWS  {name}: {n} rows ({time.time() - t0:.1f}s)")
            continue
        try:
            problems, secs = compare(spark, con, name, fn, os_[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            problems, secs = [f"error {type(e).__name__}: {str(e)[:400]}"], 0
        bad += bool(problems)
        print(("OK    " if not problems else "FAIL  ") + f"{name} ({secs:.1f}s) " + "; ".join(problems))
    print(f"{bad} failing")


if __name__ == "__main__":
    main(sys.argv)
