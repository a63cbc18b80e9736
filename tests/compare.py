"""Compare queries with their oracles: rows as a multiset, columns by name.

Usage: python -m tests.compare [folder] [name …]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from strandmart.checks.registry import TABLES


def canonical(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if hasattr(value, "is_integer") or type(value).__name__ == "Decimal":
        return round(float(value), 6)
    if hasattr(value, "isoformat"):
        return str(value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(canonical(r[i]) for i in order) for r in rows)


def database(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def compare(spark, con, folder, name, build, sql):
    df = build(spark, folder)
    got_rows = df.collect()
    got = rows_of(df.columns, got_rows)
    if sql is None:
        return len(got_rows), None
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return len(got_rows), f"columns {sorted(df.columns)} != {sorted(names)}"
    if got == want:
        return len(got_rows), ""
    extra, lack = got - want, want - got
    return len(got_rows), (
        f"spark {sum(got.values())} rows, oracle {sum(want.values())}; cols {sorted(names)}\n"
        f"   only spark  ({sum(extra.values())}): {list(extra)[:3]}\n   only oracle ({sum(lack.values())}): {list(lack)[:3]}"
    )


def main():
    from strandmart.checks import ORACLES, QUERIES
    from strandmart.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, con = local_session(8), database(folder)
    bad = []
    for name, build in QUERIES.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            count, problem = compare(spark, con, folder, name, build, ORACLES.get(name))
        except Exception as error:  # noqa: BLE001
            count, problem = -1, f"{type(error).__name__}: {str(error)[:1500]}"
        if problem:
            bad.append(name)
        state = "rows only" if problem is None else (problem or "ok")
        print(f"{name:28s} {count:8d} {time.time() - start:6.2f}s {state}", flush=True)
    print(f"{len(bad)} bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
