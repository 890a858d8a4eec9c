"""Runs queries on Spark and their SQL twins on DuckDB and compares rows, names and types.

    python tests/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return ("f", "nan")
        return ("f", repr(value + 0.0))
    if isinstance(value, Decimal):
        return ("d", str(value))
    if isinstance(value, bool):
        return ("b", str(value))
    if value is None:
        return ("n", "")
    return (type(value).__name__[:4], str(value))


def rows_of(columns, data):
    place = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in place) for r in data)


def compare(spark, con, query, sql, sf_dir):
    """Empty text when equal, else what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got)
    if got != want:
        only_got = sorted(set(got) - set(want))[:2]
        only_want = sorted(set(want) - set(got))[:2]
        return f"{len(got)} rows vs {len(want)}; e.g. spark {only_got}; duckdb {only_want}", len(got)
    return "", len(got)


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tessera.session import get_session

    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, con = get_session(), connect(sf_dir)
    oracles = oracle_sql()
    failed = 0
    for name, query in queries().items():
        if args.names and name not in args.names:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem, n = compare(spark, con, query, oracles[name], sf_dir)
            else:
                problem, n = "", query(spark, sf_dir).count()
        except Exception as e:  # noqa: BLE001
            problem, n = f"{type(e).__name__}: {str(e)[:1500]}", -1
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':4} {name:24} {n:8} rows {time.time() - start:6.2f}s {problem}", flush=True)
    print("failed:", failed)
    return int(bool(failed))


if __name__ == "__main__":
    sys.exit(main())
