"""Run registered queries against their SQL twins: ``check_queries.py [folder] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from instrel.plans.catalog import queries
from instrel.plans.oracle import ORACLE
from instrel.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


SPENT: dict[str, float] = {}


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if hasattr(value, "as_tuple"):
        return f"{float(value):.9g}"
    return str(value)


def rows(names: list[str], values: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, as texts, sorted."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in values)


def compare(spark, connection, name: str, folder: str) -> str:
    """Empty if query and SQL agree, else what differs."""
    begin = time.time()
    frame = queries()[name](spark, folder)
    got = rows(frame.columns, [tuple(r) for r in frame.collect()])
    SPENT[name] = time.time() - begin
    result = connection.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    wanted = rows(columns, result.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if got != wanted:
        extra, absent = sorted(set(got) - set(wanted))[:2], sorted(set(wanted) - set(got))[:2]
        return f"{len(got)} rows != {len(wanted)} rows; only spark {extra}; only sql {absent}"
    return "" if got else "no rows"


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(queries())
    spark = local_session("8")
    connection = oracle_connection(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, connection, name, folder) if name in ORACLE else "no SQL"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s (Spark {SPENT.get(name, 0):.2f}s) {problem[:1200]}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")


if __name__ == "__main__":
    main()
