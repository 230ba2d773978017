"""Compare registered queries with their SQL run by DuckDB on the same tables.

As a script: python -m tests.oracle [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(root).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, int) and not isinstance(value, bool):
        return float(value) if abs(value) < 2**53 else value
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = _sorted([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        extra = list(set(got[1]) - set(want[1]))[:3]
        lost = list(set(want[1]) - set(got[1]))[:3]
        return f"rows {len(got[1])} != {len(want[1])}; extra {extra}; missing {lost}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(bad)} of {len(got[1])} rows differ, first {bad[0]}" if bad else None


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as e
    from tests.conftest import make_session

    args = sys.argv[1:]
    root = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark, con = make_session(), connect(root)
    sql = e.oracle_sql()
    for name, fn in e.queries().items():
        if args and name not in args:
            continue
        t = time.time()
        try:
            df = fn(spark, root)
            if name in sql:
                verdict = compare(df, con, sql[name]) or "ok"
            else:
                verdict = f"no sql, {df.count()} rows"
        except Exception as err:  # noqa: BLE001 - a report line per query
            verdict = f"ERROR {str(err)[:1500]}"
        print(f"{name:26s} {time.time() - t:7.2f}s  {verdict}", flush=True)


if __name__ == "__main__":
    main()
