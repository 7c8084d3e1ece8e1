"""Compare registered queries with their SQL on the same parquet tables."""

from __future__ import annotations

import glob
import signal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return None if value is None else f"{type(value).__name__}:{value}"


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(normal(r[i]) for i in order) for r in rows), key=str
    )


def compare(spark_df, con, sql):
    rows = spark_df.collect()
    left = table(spark_df.columns, rows)
    if sql is None:
        return len(rows), None
    out = con.execute(sql)
    right = table([d[0] for d in out.description], out.fetchall())
    if left[0] != right[0]:
        return len(rows), f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return len(rows), f"rows {len(left[1])} != {len(right[1])}; spark {left[1][:3]} duck {right[1][:3]}"
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    return len(rows), (f"{len(bad)} rows differ, first {bad[:2]}" if bad else None)


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tallyflow.session import local_session

    folder = os.environ.get("SF", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    signal.signal(signal.SIGALRM, lambda *_: (_ for _ in ()).throw(TimeoutError("time limit")))
    for name, build in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        signal.alarm(int(os.environ.get("LIMIT", "60")))
        try:
            n, problem = compare(build(spark, folder), con, sqls.get(name))
        except Exception as error:  # noqa: BLE001
            n, problem = -1, f"{type(error).__name__}: {str(error)[:1200]}"
        signal.alarm(0)
        failed += problem is not None
        state = "FAIL" if problem else ("ok  " if name in sqls else "rows")
        print(f"{state} {name} rows={n} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("failed:", failed)
