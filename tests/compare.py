"""Runs registered queries against their DuckDB statements: `python tests/compare.py <folder> [query ...]`."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, connection, folder, query, sql):
    """None when equal, else a description of the difference."""
    df = query(spark, folder)
    mine = rows_of(df.columns, [tuple(row) for row in df.collect()])
    relation = connection.execute(sql)
    names = [column[0] for column in relation.description]
    theirs = rows_of(names, relation.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows and {len(theirs)} rows"
    for a, b in zip(mine, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{sorted(names)}\n  {str(a)[:700]}\n  {str(b)[:700]}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from pagetide.session import build_session

    folder, chosen = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    statements = oracle_sql()
    failures = 0
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            problem = compare(spark, connection, folder, query, statements[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += problem is not None
        print(f"{name}: {'ok' if problem is None else problem} ({time.time() - start:.1f} s)", flush=True)
    print(f"{failures} differences")


if __name__ == "__main__":
    main()
