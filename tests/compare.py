"""Run registered queries next to their SQL: python tests/compare.py [folder] [name ...]"""

from __future__ import annotations

import datetime
import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return c


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(norm(r[i]) for i in order) for r in rows), key=lambda r: [(x is not None, str(x)) for x in r]
    )


def compare(spark, connection, folder, name, fn, sql):
    started = time.time()
    df = fn(spark, folder)
    got = df.collect()
    took = time.time() - started
    columns, mine = rows_of(df.columns, got)
    if sql is None:
        return took, len(mine), "rows only"
    result = connection.execute(sql)
    other_columns, other = rows_of([x[0] for x in result.description], result.fetchall())
    if columns != other_columns:
        return took, len(mine), f"columns differ: {columns} {other_columns}"
    if mine != other:
        pairs = [(a, b) for a, b in zip(mine, other) if a != b][:2]
        return took, len(mine), f"rows differ: {len(mine)} {len(other)} {pairs}"
    return took, len(mine), "ok"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    for name in names:
        try:
            took, n, verdict = compare(
                spark, connection, folder, name, entry.queries()[name], entry.oracle_sql().get(name)
            )
        except Exception as e:  # report and go on
            took, n, verdict = 0, 0, f"FAILED {str(e)[:1500]}"
        print(f"{name:24s} {n:8d} {took:7.2f}s {verdict[:1800]}", flush=True)
