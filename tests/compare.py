"""Run every registered query beside its SQL check: ``python tests/compare.py [sf_dir] [key ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(spark_rows, spark_columns, sql_rows, sql_columns) -> str | None:
    if sorted(spark_columns) != sorted(sql_columns):
        return f"columns {sorted(spark_columns)} != {sorted(sql_columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} rows != {len(sql_rows)}"
    a = sorted_rows(spark_columns, [tuple(r) for r in spark_rows])
    b = sorted_rows(sql_columns, sql_rows)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, first {str(bad[0])[:600]}"
    kinds = {type(v) for row in a for v in row} - {type(v) for row in b for v in row}
    return f"value types {kinds}" if kinds else None


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    wanted = sys.argv[2:]
    failed = []
    for key, fn in entry.queries().items():
        if wanted and key not in wanted:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            rows = df.collect()
            spent = time.time() - start
            if key not in sql:
                print(f"{key:24} rows only {len(rows):8} {spent:6.1f}s", flush=True)
                continue
            start = time.time()
            result = con.execute(sql[key])
            columns = [d[0] for d in result.description]
            why = difference(rows, df.columns, result.fetchall(), columns)
            print(f"{key:24} {'ok' if why is None else why} {len(rows):8} {spent:6.1f}s sql {time.time() - start:5.1f}s", flush=True)
        except Exception as err:  # noqa: BLE001
            why = f"{type(err).__name__}: {str(err)[:300]}"
            print(f"{key:24} {why}", flush=True)
        if why is not None:
            failed.append(key)
    print("failed:", failed or "none")


if __name__ == "__main__":
    main()
