"""Run registered queries against their DuckDB statements over one folder."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return f"date {value.isoformat()}"
    if isinstance(value, float):
        return "nan" if value != value else repr(value)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    return value if value is None or isinstance(value, str) else repr(value)


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(frame, connection, sql: str) -> str | None:
    """None when the rows agree, otherwise a short description."""
    spark_rows = frame.collect()
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    oracle_rows = result.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if len(spark_rows) != len(oracle_rows):
        return f"{len(spark_rows)} rows != {len(oracle_rows)}"
    left, right = _sorted_rows(frame.columns, spark_rows), _sorted_rows(names, oracle_rows)
    if left != right:
        wrong = [(a, b) for a, b in zip(left, right) if a != b]
        cells = [(n, x, y) for n, x, y in zip(sorted(names), *wrong[0]) if x != y]
        return f"{len(wrong)} rows differ, first {cells}"
    return None


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry

    from keepwell.session import local_session

    folder = sys.argv[1]
    wanted = sys.argv[2:] or list(entry.queries())
    spark = local_session(8, **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(folder)
    oracles, bad = entry.oracle_sql(), 0
    for name in wanted:
        started = time.time()
        try:
            frame = entry.queries()[name](spark, folder)
            if name in oracles:
                found = difference(frame, connection, oracles[name])
            else:
                found = None
                print(f"      rows only: {len(frame.collect())}")
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - started:.2f}s {found or ''}", flush=True)
    print(f"{len(wanted)} checked, {bad} failed, {sum(n in oracles for n in wanted)} with SQL")


if __name__ == "__main__":
    main()
