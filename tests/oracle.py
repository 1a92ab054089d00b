"""Runs a registered query and its DuckDB twin side by side.

``python -m tests.oracle [sf_dir] [name ...]`` reports every query.
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, Decimal)):
        return repr(round(float(value), 6))
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _kind(name: str) -> str:
    name = name.lower()
    return {"varchar": "string", "integer": "int"}.get(name, name)


def compare(df, con, sql: str) -> list[str]:
    """Differences in columns, types or the multiset of rows; empty when equal."""
    result = con.execute(sql)
    twin_types = {c[0]: _kind(str(c[1])) for c in result.description}
    twin_rows = result.fetchall()
    names = sorted(df.columns)
    if names != sorted(twin_types):
        return [f"columns {names} != {sorted(twin_types)}"]
    problems = []
    ours = {c: _kind(k) for c, k in df.dtypes}
    for c in names:
        if ours[c] != twin_types[c]:
            problems.append(f"type of {c}: {ours[c]} != {twin_types[c]}")
    order = [list(twin_types).index(c) for c in names]
    left = Counter(tuple(_plain(r[c]) for c in names) for r in df.collect())
    right = Counter(tuple(_plain(r[i]) for i in order) for r in twin_rows)
    if left != right:
        problems.append(f"rows {sum(left.values())} vs {sum(right.values())}")
        problems += [f"  only ours: {str(r)[:600]}" for r in list((left - right))[:2]]
        problems += [f"  only twin: {str(r)[:600]}" for r in list((right - left))[:2]]
    return problems


def main(argv: list[str]) -> int:
    from moodtide.session import build_session, run_scratch

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    chosen = argv[1:]
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, twins, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            with run_scratch(spark):
                df = fn(spark, sf_dir)
                if name in twins:
                    problems = compare(df, con, twins[name])
                else:
                    problems = [] if df.count() else ["no rows"]
        except Exception as exc:  # report and go on with the next query
            problems = [f"{type(exc).__name__}: {str(exc)[:700]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", flush=True)
        for p in problems:
            print("     ", p, flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
