"""Compare registered queries with their SQL: `python tests/oracle.py [sf] [query ...]`."""

from __future__ import annotations

import datetime as dt
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, con, folder: str, query, sql: str) -> tuple[int, str]:
    """Number of rows of the query, and what differs from the SQL ("" if nothing)."""
    df = query(spark, folder)
    mine = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return len(mine), f"columns {sorted(df.columns)} against {sorted(names)}"
    if mine == theirs:
        return len(mine), ""
    only_mine, only_theirs = sorted(set(mine) - set(theirs), key=repr), sorted(set(theirs) - set(mine), key=repr)
    return len(mine), (
        f"{len(mine)} rows against {len(theirs)}; {len(only_mine)} differ; {only_mine[:2]} | {only_theirs[:2]}"
    )


def main() -> int:
    import __spark_entry__ as entry
    from candles.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    folder = f"/root/testdata/{sf}"
    spark = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        begun = time.time()
        try:
            if name in oracles:
                n, diff = differences(spark, con, folder, queries[name], oracles[name])
            else:
                n, diff = queries[name](spark, folder).count(), ""
        except Exception as error:  # report and go on with the other queries
            n, diff = -1, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {name:28s} {n:8d} rows {time.time() - begun:6.1f}s {diff}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
