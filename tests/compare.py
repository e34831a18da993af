"""Run registered queries next to their SQL counterparts and compare rows by value."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set timezone='UTC'")
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def plain(value: object) -> object:
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    if hasattr(value, "isoformat"):
        return value.isoformat()[:19]
    return value


def sort_key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v).__name__) if v is not None else "", str(v)) for v in row)


def shaped(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(picked, key=sort_key)


def difference(spark, connection, query, sql: str, folder: str) -> str | None:
    """None for equal results, else a short description of the first difference."""
    frame = query(spark, folder)
    mine = shaped(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = connection.execute(sql)
    theirs = shaped([c[0] for c in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {sorted(set(mine[0]) ^ set(theirs[0]))}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows against {len(theirs[1])}"
    bad = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    if not bad:
        return None
    a, b = bad[0]
    cells = [(c, x, y) for c, x, y in zip(mine[0], a, b) if x != y]
    return f"{len(bad)} rows differ, first: {cells} in {a}"


def main(folder: str, names: list[str]) -> None:
    from conftest import session

    import __spark_entry__ as entry

    spark, connection = session(), duck(folder)
    queries, statements = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or list(queries):
        start = time.time()
        try:
            found = difference(spark, connection, queries[name], statements[name], folder)
        except Exception as error:  # noqa: BLE001
            found = f"error {str(error)[:500]}"
        failed += found is not None
        print(f"{name:26s}{time.time() - start:7.2f}s  {found or 'equal'}", flush=True)
    print(f"{failed} differ")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
