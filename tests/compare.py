"""Run registered queries next to their DuckDB SQL and report differences."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


# significant digits compared of a double; 17 is bit for bit
DIGITS = int(os.environ.get("COMPARE_DIGITS", "17"))


def plain(value):
    """A comparable form: numbers by value, whatever their type."""
    if value is None or isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value:.{DIGITS}g}"
    if isinstance(value, int):
        return f"{float(value):.{DIGITS}g}" if abs(value) < 2**53 else str(value)
    try:
        return f"{float(value):.{DIGITS}g}" if type(value).__name__ == "Decimal" else str(value)
    except ValueError:
        return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def difference(df, con, sql):
    """None if equal, else a short text."""
    got = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    want = rows_of(names, cursor.fetchall())
    mine = rows_of(df.columns, got)
    if len(want) != len(mine):
        return f"rows {len(mine)} instead of {len(want)}"
    bad = [(a, b) for a, b in zip(mine, want) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


if __name__ == "__main__":
    from conftest import session

    import __spark_entry__ as entry

    folder = sys.argv[1]
    only = sys.argv[2:]
    spark, con = session(), connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in only or queries:
        started = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                found = difference(df, con, oracles[name])
            else:
                found = None if df.count() else "no rows"
        except Exception as problem:  # noqa: BLE001
            found = f"{type(problem).__name__}: {str(problem)[:600]}"
        failed += bool(found)
        kind = "O" if name in oracles else "R"
        print(f"{'FAIL' if found else 'ok  '} {kind} {name} {time.time() - started:.1f}s {found or ''}", flush=True)
    print("oracles without query:", sorted(set(oracles) - set(queries)))
    print("failed:", failed)
