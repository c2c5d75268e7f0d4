"""Run queries next to their SQL counterparts and compare every value.

    python -m checks.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import math
import time
from collections import Counter
from pathlib import Path

import duckdb


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return "-0" if value == 0 and math.copysign(1, value) < 0 else float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def compare(df, con, sql: str | None) -> tuple[str, int]:
    """('ok' | what differs, row count)."""
    got = df.collect()
    if sql is None:
        return ("ok (rows only)" if got else "EMPTY"), len(got)
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} vs {sorted(names)}", len(got)
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    for f in df.schema.fields:
        if str(kinds[f.name]) == "HUGEINT" or f.dataType.simpleString().startswith("decimal"):
            return f"TYPE {f.name}: {f.dataType.simpleString()} vs {kinds[f.name]}", len(got)
    have = rows_of(df.columns, got)
    if have != want:
        extra, missing = have - want, want - have
        return (
            f"ROWS {sum(have.values())} vs {sum(want.values())}; only spark "
            f"{sum(extra.values())} {list(extra)[:2]}; only sql {list(missing)[:2]}",
            len(got),
        )
    return ("ok" if got else "ok but EMPTY"), len(got)


def main() -> int:
    from checks.registry import ORACLES, QUERIES
    from tickflow.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session(8)
    con = oracle_connection(args.sf)
    failed = 0
    for name in args.names or list(QUERIES):
        start = time.time()
        try:
            verdict, n = compare(QUERIES[name](spark, args.sf), con, ORACLES.get(name))
        except Exception as error:  # noqa: BLE001 - report and go on
            verdict, n = f"ERROR {type(error).__name__}: {str(error)[:600]}", 0
        failed += not verdict.startswith("ok")
        print(f"{name:28s} {n:8d} {time.time() - start:6.2f}s  {verdict}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
