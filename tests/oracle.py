"""Compare every registered query with its SQL counterpart: ``python -m tests.oracle <sf> [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con, sf_dir: str, query, sql: str) -> str:
    """An empty string where both sides agree in column names and values."""
    frame = query(spark, sf_dir)
    got = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    answer = con.execute(sql)
    names = [column[0] for column in answer.description]
    want = rows_of(names, answer.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    kinds = {name: TYPES.get(kind, kind) for name, kind in frame.dtypes}
    wanted = {column[0]: str(column[1]) for column in answer.description}
    if kinds != wanted:
        return f"types {kinds} != {wanted}"
    different = [(a, b) for a, b in zip(got, want) if a != b]
    if different:
        return f"{len(different)} of {len(got)} rows differ, first: {str(different[0])[:400]}"
    return ""


def main(sf: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from tests.session import local_session

    spark = local_session(8)
    sf_dir = f"/root/testdata/sf{sf}"
    con, sql, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sql:
                problem = compare(spark, con, sf_dir, query, sql[name])
                status = problem or "equal"
            else:
                problem = ""
                status = f"{len(query(spark, sf_dir).collect())} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            problem = status = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{name:32s} {time.time() - start:6.1f}s  {status}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
