"""Run registered queries on Spark and their SQL twins on DuckDB, and compare whole results."""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _value(v):
    if isinstance(v, bool) or v is None:
        return ("b", v)
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v.normalize()))
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, float):
        return ("f", repr(v))
    if isinstance(v, (datetime.datetime, datetime.date)):
        return ("t", v.isoformat())
    if isinstance(v, str):
        return ("s", v)
    raise TypeError(f"not a comparable scalar: {type(v)}")


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, run, sql, sf_dir) -> str | None:
    """None when equal, else what differs."""
    df = run(spark, sf_dir)
    got = _rows(df.columns, df.collect())
    if sql is None:
        return None if got[1] else "no rows"
    found = con.execute(sql)
    want = _rows([d[0] for d in found.description], found.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        ours, theirs = Counter(got[1]), Counter(want[1])
        extra, missing = list(ours - theirs)[:2], list(theirs - ours)[:2]
        return f"{len(got[1])} rows, expected {len(want[1])}; only here: {extra}; only there: {missing}"
    if not got[1]:
        return "no rows on either side"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry

    from tamizal.session import build_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    chosen = sys.argv[1:]
    session = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("OFF")
    connection = connect(sf)
    oracle = entry.oracle_sql()
    failed = 0
    for query, runner in entry.queries().items():
        if chosen and not any(query.startswith(c) for c in chosen):
            continue
        start = time.time()
        try:
            problem = compare(session, connection, query, runner, oracle.get(query), sf)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {query} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
