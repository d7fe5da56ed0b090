"""Runs registered queries beside their SQL: ``python tests/oracle_check.py [--hot] [sf] [prefix ...]``.

``--hot`` treats every group as too large for one task, so all ordered scans are split into blocks.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
import traceback
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(sf_dir):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return str(value)
    if isinstance(value, (int, Decimal, float)):
        number = float(value)
        if math.isnan(number):
            return "nan"
        return f"{number:.10g}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day).isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, sf_dir, name, build, sql):
    """None when equal, otherwise what differs."""
    df = build(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", len(got)
    if got != want:
        wanted, found = set(want), set(got)
        extra = [r for r in got if r not in wanted][:2]
        missing = [r for r in want if r not in found][:2]
        return f"rows {len(got)} vs {len(want)}\n   cols {sorted(columns)}\n   got  {extra}\n   want {missing}", len(got)
    return None, len(got)


def main(argv):
    import __spark_entry__ as contract
    from tidewell.session import local_session

    hot = "--hot" in argv
    argv = [a for a in argv if a != "--hot"]
    sf = argv[1] if len(argv) > 1 else "0.01"
    prefixes = tuple(argv[2:]) or ("",)
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session()
    if hot:
        spark.conf.set("spark.tidewell.hotGroupRows", "0")
    connection = duck(sf_dir)
    oracles = contract.oracle_sql()
    bad = 0
    for name, build in contract.queries().items():
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem, count = compare(spark, connection, sf_dir, name, build, oracles[name])
            else:
                problem, count = None, build(spark, sf_dir).count()
        except Exception as error:  # report and go on with the next query
            text = str(error).split("JVM stacktrace")[0][:700]
            problem, count = f"{type(error).__name__}: {text}", -1
            if not text.strip():
                traceback.print_exc()
        status = "ok  " if problem is None else "FAIL"
        note = "" if name in oracles else " (rows only)"
        print(f"{status} {name} rows={count} {time.time() - start:.2f}s{note}", flush=True)
        if problem:
            bad += 1
            print("   " + problem, flush=True)
        elif count == 0:
            print("   EMPTY", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
