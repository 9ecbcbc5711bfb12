"""Run registered queries beside their oracle SQL and report differences.

Usage: python tests/oracle_check.py sf0.01 [name ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as spark_entry  # noqa: E402
from readloom.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def canonical(rows, columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r),
    )


QUERIES = spark_entry.queries()
SQL = spark_entry.oracle_sql()


def compare(spark, con, folder: str, name: str) -> tuple[str, int]:
    """'ok', 'rows' (no SQL) or a description of the first difference, and the row count."""
    df = QUERIES[name](spark, folder)
    left = canonical([tuple(r) for r in df.collect()], df.columns)
    sql = SQL.get(name)
    if sql is None:
        return "rows", len(left)
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", len(left)
    right = canonical(result.fetchall(), columns)
    if left == right:
        return "ok", len(left)
    extra = [r for r in left if r not in set(right)][:2]
    missing = [r for r in right if r not in set(left)][:2]
    return f"{len(left)} vs {len(right)} rows; spark only {extra}; sql only {missing}", len(left)


def main() -> None:
    folder = f"/root/testdata/{sys.argv[1]}"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("oracle-check")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            verdict, rows = compare(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001 - report and go on to the next query
            verdict, rows = f"{type(error).__name__}: {str(error)[:600]}", 0
        bad += verdict not in ("ok", "rows")
        print(f"{name:32s} {rows:8d} {time.time() - start:6.1f}s  {verdict[:900]}", flush=True)
    print(f"{len(names)} queries, {bad} differ")


if __name__ == "__main__":
    main()
