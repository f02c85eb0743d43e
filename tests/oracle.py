"""Run bound queries on Spark and their SQL on DuckDB; compare results.

Usable from pytest and as a script: ``python tests/oracle.py sf_dir [name …]``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def plan_text(df) -> str:
    """The physical plan as ``explain()`` prints it."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


# Plan nodes no bound query may contain: all-pairs joins, row-at-a-time Python.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def compare(spark, name, fn, sql, sf_dir, con=None, plans=None):
    con = con or duck(sf_dir)
    t = time.time()
    df = fn(spark, sf_dir)
    if plans is not None:
        plans[name] = plan_text(df)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    el = time.time() - t
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns {sorted(s_cols)} != {sorted(d_cols)}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows {len(s_rows)} != {len(d_rows)}")
    if not problems:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        if a != b:
            bad = next(i for i in range(len(a)) if a[i] != b[i])
            problems.append(f"values differ, first at {bad}: {a[bad]} vs {b[bad]}")
    return problems, len(s_rows), el


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from panelflow.session import get_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(e.queries())
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for n in names:
        if n not in sqls:
            df = qs[n](spark, sf_dir)
            print(f"{n:28s} rows-only {df.count()}")
            continue
        plans = {}
        try:
            problems, rows, el = compare(spark, n, qs[n], sqls[n], sf_dir, con, plans)
            problems += [f"plan has {node}" for node in FORBIDDEN if node in plans.get(n, "")]
        except Exception as ex:  # report and go on
            problems, rows, el = [f"{type(ex).__name__}: {str(ex)[:300]}"], -1, 0
        bad += bool(problems)
        print(f"{n:28s} {'OK ' if not problems else 'BAD'} rows={rows} {el:.2f}s {'; '.join(problems)}")
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
