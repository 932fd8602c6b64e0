"""Run every registered query against its oracle and report differences.

    python -m verification.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def oracle_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    relation = connection.sql(sql)
    return _sorted(relation.columns, relation.fetchall())


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return _sorted(df.columns, [tuple(row) for row in df.collect()])


def _sorted(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=repr)


def differences(df, connection, sql: str) -> str | None:
    """None if both sides have the same columns, value types and rows."""
    left, right = spark_rows(df), oracle_rows(connection, sql)
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows != {len(right[1])}"
    for ours, theirs in zip(left[1], right[1]):
        kinds = [type(v) for v in ours], [type(v) for v in theirs]
        if ours != theirs or kinds[0] != kinds[1]:
            return f"{ours} != {theirs}"
    return None


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    from shopledger.session import local_session
    from verification.oracle import oracle
    from verification.queries import registered

    spark = local_session("8")
    connection = connect(folder)
    sql, failed = oracle(), 0
    for name, build in registered().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            problem = differences(build(spark, folder), connection, sql[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
