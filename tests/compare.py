"""Run registered queries against their SQL and compare rows, columns and values."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def difference(spark_rows, spark_columns, result) -> str:
    """Empty if both sides hold the same multiset of rows, else what differs."""
    columns = [d[0] for d in result.description]
    rows = result.fetchall()
    if sorted(columns) != sorted(spark_columns):
        return f"columns {spark_columns} vs {columns}"
    order = [columns.index(c) for c in spark_columns]
    left = sorted(map(repr, (tuple(r) for r in spark_rows)))
    right = sorted(map(repr, (tuple(r[i] for i in order) for r in rows)))
    if left == right:
        return ""
    only_left, only_right = sorted(set(left) - set(right)), sorted(set(right) - set(left))
    return f"{len(left)} vs {len(right)} rows; only in Spark {only_left[:3]}; only in SQL {only_right[:3]}"


def main(folder: str, names: list[str]) -> None:
    from __spark_entry__ import oracle_sql, queries
    from termloom import local_session

    spark = local_session("8", memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, bad = connect(folder), oracle_sql(), []
    for name, build in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = build(spark, folder)
            rows = frame.collect()
            middle = time.time()
            problem = difference(rows, frame.columns, connection.execute(sql[name])) if name in sql else "no SQL"
            kinds = "" if name not in sql else " ".join(str(t) for t in connection.execute(sql[name]).description and [d[1] for d in connection.description])
            print(f"{name:24} {len(rows):8} rows  {middle - start:6.2f}s  {time.time() - middle:6.2f}s  {problem or 'equal'} | {frame.dtypes} {kinds}", flush=True)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
            print(f"{name:24} FAILED {problem}", flush=True)
        if problem not in ("", "no SQL"):
            bad.append(name)
    print("differing:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
