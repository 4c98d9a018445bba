"""Run registered queries and their oracle SQL side by side."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v:.6g}" if v != int(v) or abs(v) > 1e15 else str(int(v))
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return str(v)


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in data)


def compare(spark, con, q, sf_dir):
    df = q.run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if q.sql is None:
        return len(got), None
    cur = con.execute(q.sql)
    cols = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    exp = cur.fetchall()
    problems = []
    if sorted(cols) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(cols)}")
    else:
        a, b = rows(df.columns, got), rows(cols, exp)
        if len(a) != len(b):
            problems.append(f"rows {len(a)} != {len(b)}")
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        if bad:
            problems.append(f"{len(bad)} rows differ, e.g. {sorted(cols)}\n   spark {bad[0][0]}\n   duck  {bad[0][1]}")
        kinds = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
        loose = [f"{c}:{t}/{types[c]}" for c, t in df.dtypes if kinds.get(t) != types[c]]
        if loose:
            problems.append("types " + " ".join(loose))
    return len(got), "; ".join(problems)


def main():
    from berthlake.registry import load_all
    from berthlake.session import get_spark

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = get_spark("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                                   "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    names = sys.argv[1:]
    for name, q in load_all().items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        t = time.time()
        try:
            n, problem = compare(spark, con, q, sf)
            state = "rows-only" if problem is None else ("OK" if not problem else "DIFF " + problem)
        except Exception as e:  # noqa: BLE001
            n, state = 0, "ERROR " + str(e)[:1500]
        print(f"{name:36s} {n:8d} {time.time() - t:6.2f}s {state}", flush=True)


if __name__ == "__main__":
    main()
