"""Run registered queries on Spark and their SQL on DuckDB and compare whole results."""

from __future__ import annotations

import os
import re
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SAME = {"bigint": "BIGINT", "int": "INTEGER", "tinyint": "TINYINT", "double": "DOUBLE",
        "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
        "timestamp": "TIMESTAMP", "float": "FLOAT"}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, Decimal):
        return format(v, "f")
    if isinstance(v, float):
        return repr(v)
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None):
        v = v.replace(tzinfo=None)
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def spark_type(t: str) -> str:
    return re.sub(r"^decimal", "DECIMAL", t) if t.startswith("decimal") else SAME.get(t, t)


def compare(spark, sf: str, query, sql: str | None, con=None) -> list[str]:
    """Differences found, empty when both sides agree (no SQL: only that the query runs)."""
    df = query(spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return [] if df.columns else ["no columns"]
    con = con or connect(sf)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want = rows_of(names, cur.fetchall())
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} vs {sorted(names)}")
    for n, t in df.dtypes:
        if n in kinds and spark_type(t) != kinds[n].replace(" ", ""):
            problems.append(f"type of {n}: {t} vs {kinds[n]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} vs {len(want)}")
    elif got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        problems.append(f"{len(bad)} rows differ, first {bad[0]}")
    return problems


if __name__ == "__main__":
    from millrace.session import lake_session
    from millrace.workload import registry

    sf = sys.argv[1]
    picked = sys.argv[2:]
    spark = lake_session("oracle", "local[8]", spark__sql__shuffle__partitions="8",
                         spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = 0
    for name, (query, sql) in registry().items():
        if picked and not any(re.fullmatch(p, name) for p in picked):
            continue
        t0 = time.time()
        try:
            found = compare(spark, sf, query, sql, con)
        except Exception as exc:  # report and go on with the next query
            found = [f"{type(exc).__name__}: {str(exc)[:1500]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok':4} {name:28} {time.time() - t0:6.2f}s"
              f"{'' if sql else '  (rows only)'}", *found, sep="\n     " if found else " ", flush=True)
    print("failed", failed)
