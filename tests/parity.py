"""Compare every query with its oracle: python -m tests.parity [sf_dir] [name ...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

import __spark_entry__ as entry_module
from feeloom.session import local_session


def oracle_connection(sf_dir: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return ("f", "nan" if math.isnan(value) else repr(value + 0.0))
        return ("n" if value is None else type(value).__name__, str(value))

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, connection, sf_dir: str, name: str) -> str | None:
    """None if equal, else what differs."""
    df = entry_module.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    cursor = connection.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    a, b = normal(got, df.columns), normal(want, columns)
    if a != b:
        extra = [r for r in a if r not in set(b)][:2]
        lacking = [r for r in b if r not in set(a)][:2]
        return f"{len(a)} rows against {len(b)}; only here {extra}; only in oracle {lacking}"
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry_module.oracle_sql())
    spark = local_session("parity")
    connection = oracle_connection(sf_dir)
    failures = 0
    for name in names:
        started = time.time()
        try:
            problem = compare(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{failures} of {len(names)} differ")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
