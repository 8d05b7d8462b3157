"""Compare registered queries with their check SQL: python tests/check.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def norm(value):
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if hasattr(value, "asDict"):
        return tuple(sorted((k, norm(v)) for k, v in value.asDict().items()))
    if isinstance(value, dict):
        return tuple(sorted((k, norm(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(norm(v) for v in value)
    return value


def compare(spark, sf_dir, fn, sql):
    """(problem or None, rows): same columns, same row multiset."""
    df = fn(spark, sf_dir)
    names = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in names) for r in df.collect()), key=repr)
    if sql is None:
        return None, len(got)
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    if sorted(columns) != names:
        return f"columns differ: {names} / {sorted(columns)}", len(got)
    places = [columns.index(c) for c in names]
    want = sorted((tuple(norm(r[i]) for i in places) for r in cur.fetchall()), key=repr)
    if got == want:
        return None, len(got)
    only_got = [r for r in got if r not in set(want)][:3] if len(got) < 200_000 else got[:1]
    only_want = [r for r in want if r not in set(got)][:3] if len(want) < 200_000 else want[:1]
    return f"rows differ: {len(got)} / {len(want)}; spark only {str(only_got)[:600]}; sql only {str(only_want)[:600]}", len(got)


if __name__ == "__main__":
    from marquee.plans import all_queries
    from marquee.session import get_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    session = get_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    queries, check_sql = all_queries()
    failed = []
    for name in args or queries:
        start = time.time()
        try:
            problem, rows = compare(session, sf_dir, queries[name], check_sql.get(name))
        except Exception as error:  # noqa: BLE001
            problem, rows = f"{type(error).__name__}: {str(error)[:700]}", 0
        state = "FAIL" if problem else ("ok" if name in check_sql else "rows-only")
        print(f"{state:9} {name:28} {rows:8} rows {time.time() - start:6.1f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)
