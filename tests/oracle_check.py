"""Runs catalogue queries and their SQL side by side and reports differences."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 6) + 0.0
    if hasattr(value, "to_pydatetime"):
        value = value.to_pydatetime()
    if hasattr(value, "isoformat"):
        return value.isoformat().replace("T00:00:00", "")
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"first difference\n   spark {a}\n   sql   {b}"
    return None


def main(sf: str, *names: str) -> int:
    from __spark_entry__ import oracle_sql, queries

    from tillworks.session import build_session

    sf_dir = f"/root/testdata/{sf}"
    spark = build_session(master="local[8]", partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, bad = oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = difference(spark, con, query, oracles[name], sf_dir)
                kind = "sql"
            else:
                df = query(spark, sf_dir)
                problem, kind = None, f"rows only ({len(df.collect())})"
        except Exception as error:  # report and go on with the next query
            problem, kind = f"{type(error).__name__}: {str(error)[:1500]}", "error"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name} {kind}", flush=True)
        if problem:
            print("   ", problem, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main(*sys.argv[1:]))
