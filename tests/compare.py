"""Runs registered queries next to their SQL in DuckDB: python -m tests.compare [sf] [names]."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """What is not equal between a DataFrame and a SQL result; empty when all is."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"]
    ours = _bag(df.columns, (tuple(r) for r in df.collect()))
    theirs = _bag(names, cursor.fetchall())
    found = []
    if sum(ours.values()) != sum(theirs.values()):
        found.append(f"rows {sum(ours.values())} vs {sum(theirs.values())}")
    if ours != theirs:
        found.append(f"only ours {list((ours - theirs).items())[:3]}, "
                     f"only SQL {list((theirs - ours).items())[:3]}")
    kinds = [{type(v).__name__ for v in col if v is not None} for bag in (ours, theirs)
             for col in [[row[i] for row in list(bag)[:200]] for i in range(len(names))]]
    half = len(names)
    for name, a, b in zip(sorted(names), kinds[:half], kinds[half:]):
        if a and b and a - {"str"} != b - {"str"}:
            found.append(f"types of {name}: {a} vs {b}")
    if not theirs:
        found.append("note: no rows")
    return found


def main() -> int:
    from tests.sessions import local_session
    import __spark_entry__ as entry
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    spark = local_session()
    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    failed = 0
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        began = time.time()
        try:
            df = fn(spark, sf_dir)
            found = differences(df, con, entry.oracle_sql()[name]) \
                if name in entry.oracle_sql() else [f"no SQL, {df.count()} rows"]
        except Exception as e:  # report and go on
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        failed += bool(found) and "note" not in found[0] and "no SQL" not in found[0]
        print(f"{name:32s} {time.time() - began:6.2f}s {'ok' if not found else found}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.path.insert(0, os.getcwd())
    sys.exit(main())
