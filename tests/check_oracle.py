"""Compare registered queries with their SQL twins: ``python tests/check_oracle.py SF [name ...]``."""

from __future__ import annotations

import os
import sys
import time
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    if isinstance(value, Decimal):
        return f"{value:f}"
    return value


def _key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(cells, key=_key)


def differences(spark, con, name: str, sf_dir: str) -> str | None:
    """None when the query and its twin agree in columns, row count and every value."""
    from abacist.plans.catalog import QUERIES
    from abacist.plans.oracle import ORACLE

    df = QUERIES[name](spark, sf_dir)
    got_columns, got = normalised(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(ORACLE[name])
    want_columns = [c[0] for c in result.description]
    want_columns, want = normalised(want_columns, result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} vs {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            at = [i for i, (x, y) in enumerate(zip(a, b)) if x != y][0]
            return f"{got_columns[at]}: {a[at]!r} vs {b[at]!r} in {a[:8]} vs {b[:8]}"
    return None


def main() -> int:
    from abacist import get_session
    from abacist.plans.catalog import QUERIES
    from abacist.plans.oracle import ORACLE

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(QUERIES)
    spark = get_session(
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        start = time.time()
        if name not in ORACLE:
            print(f"---- {name}: no twin")
            continue
        try:
            diff = differences(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the other queries
            diff = f"{type(error).__name__}: {str(error)[:400]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'BAD '} {name} {time.time() - start:.2f}s {diff or ''}")
    print(f"{len(names)} queries, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
