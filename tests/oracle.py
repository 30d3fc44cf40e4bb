"""Compare registered queries with their SQL oracle. `python -m tests.oracle [sf] [query ...]`."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

import __spark_entry__ as entry
from tillwright.session import local_session

DATA = Path("/root/testdata")
SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def connect(folder: str):
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, con, folder: str, name: str) -> str | None:
    """None if equal, else what differs. Values must be equal to the last bit."""
    frame = entry.queries()[name](spark, folder)
    got = rows_of(frame.columns, frame.collect())
    result = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    types = {n: str(d[1]) for n, d in zip(names, result.description)}
    odd = {n: (t, types[n]) for n, t in frame.dtypes if SQL_TYPES.get(t) != types[n]}
    if odd:
        return f"types {odd}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    differing = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(differing)} rows differ, first {differing[0]}" if differing else None


def main(sf: str = "sf0.01", *only: str) -> None:
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    folder = str(DATA / sf)
    con = connect(folder)
    for name in only or entry.queries():
        start = time.time()
        if name in entry.oracle_sql():
            fault = compare(spark, con, folder, name)
            print(f"{'ok  ' if fault is None else 'FAIL'} {name} {time.time() - start:.2f}s {fault or ''}", flush=True)
        else:
            frame = entry.queries()[name](spark, folder)
            print(f"rows {name} {len(frame.collect())} {time.time() - start:.2f}s", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
