"""Compare queries with their SQL: python -m verification.run [sf_dir] [name prefix ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from verification import catalog, fixtures


def normal(value):
    if isinstance(value, float):
        return round(value, 6) if math.isfinite(value) else repr(value)
    return value


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in data), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> str:
    started = time.time()
    df = catalog.QUERIES[name](spark, sf_dir)
    got = rows(df.columns, df.collect())
    took = time.time() - started
    if name not in catalog.ORACLES:
        return f"ok    {name}: {len(got)} rows, no SQL, {took:.1f}s"
    cursor = con.sql(catalog.ORACLES[name])
    want = rows(cursor.columns, cursor.fetchall())
    if sorted(df.columns) != sorted(cursor.columns):
        return f"FAIL  {name}: columns {sorted(df.columns)} / {sorted(cursor.columns)}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        missing = [r for r in want if r not in set(got)][:2]
        return f"FAIL  {name}: {len(got)} / {len(want)} rows; only Spark {extra}; only SQL {missing}"
    note = "" if got else "  EMPTY"
    return f"ok    {name}: {len(got)} rows, {took:.1f}s + {time.time() - started - took:.1f}s{note}"


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in fixtures.GIVEN:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def main(sf_dir: str = "/root/testdata/sf0.001", *prefixes: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    bad = 0
    for name in catalog.QUERIES:
        if prefixes and not name.startswith(prefixes):
            continue
        try:
            line = compare(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            line = f"FAIL  {name}: {type(error).__name__} {str(error)[:700]}"
        bad += line.startswith("FAIL")
        print(line, flush=True)
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
