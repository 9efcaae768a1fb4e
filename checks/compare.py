"""Run registered queries against their SQL: ``python -m checks.compare [dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

from .oracles import ORACLES
from .queries import QUERIES


def canonical(rows: list[tuple]) -> list[tuple]:
    def cell(value):
        if isinstance(value, float) and value == 0:
            return "0.0"
        if hasattr(value, "tzinfo"):
            value = value.replace(tzinfo=None)
        return str(value)

    return sorted(tuple(cell(v) for v in row) for row in rows)


def sql_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as db:
        db.execute("SET TimeZone = 'UTC'")
        for file in os.listdir(sf_dir):
            name = file.removesuffix(".parquet")
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{file}'")
        result = db.execute(sql)
        columns = [c[0] for c in result.description]
        order = sorted(range(len(columns)), key=columns.__getitem__)
        return sorted(columns), canonical([tuple(r[i] for i in order) for r in result.fetchall()])


def spark_rows(spark: SparkSession, sf_dir: str, name: str) -> tuple[list[str], list[tuple]]:
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    return columns, canonical([tuple(r) for r in df.select(*columns).collect()])


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    scratch = tempfile.TemporaryDirectory(prefix="compare-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.checkpoint.dir", scratch.name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.perf_counter()
        try:
            got = spark_rows(spark, sf_dir, name)
            took = time.perf_counter() - start
            if name not in ORACLES:
                print(f"rows  {name}: {len(got[1])} rows, {took:.1f}s", flush=True)
                continue
            want = sql_rows(sf_dir, ORACLES[name])
        except Exception as error:  # report and go on with the next query
            print(f"FAIL  {name}: {str(error)[:1500]}", flush=True)
            bad += 1
            continue
        if got == want:
            print(f"same  {name}: {len(got[1])} rows, {took:.1f}s", flush=True)
            continue
        bad += 1
        print(f"DIFF  {name}: {len(got[1])} and {len(want[1])} rows, columns {got[0]} and {want[0]}")
        ours, theirs = set(got[1]), set(want[1])
        print("   only Spark:", sorted(ours - theirs)[:3])
        print("   only SQL:  ", sorted(theirs - ours)[:3], flush=True)
    spark.stop()
    scratch.cleanup()
    return bad


if __name__ == "__main__":
    sys.exit(main())
