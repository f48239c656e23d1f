"""Run registered queries and their SQL over the same tables and compare the rows."""

from __future__ import annotations

import sys
import time

import duckdb

from oracle.queries import all_sql

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if value is None or value != value:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(0.0 if value == 0 else value)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, name: str, query, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    frame = query(spark, sf_dir)
    ours = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    differing = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(differing)} of {len(ours)} rows differ, first {differing[0]}" if differing else None


def main(sf_dir: str, only: list[str]) -> int:
    from stocktide.registry import QUERIES
    from stocktide.session import local_session

    spark, con, sql, failed = local_session(), connect(sf_dir), all_sql(), 0
    for name in only or QUERIES:
        started = time.time()
        try:
            problem = compare(spark, con, sf_dir, name, QUERIES[name], sql[name]) if name in sql else "no SQL"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
