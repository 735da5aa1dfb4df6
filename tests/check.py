"""Compare every registered query with its SQL counterpart: ``python tests/check.py [sf_dir] [name …]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as contract
from tillwatch.session import build_session


def sql_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as db:
        for table in Path(sf_dir).glob("*.parquet"):
            db.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
        result = db.execute(sql)
        names = [column[0] for column in result.description]
        return names, result.fetchall()


def comparable(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else value
        return value

    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


def difference(spark: SparkSession, name: str, sf_dir: str) -> tuple[int, str | None]:
    """Row count, and the first difference between query and SQL or None."""
    result = contract.queries()[name](spark, sf_dir)
    ours = comparable(result.columns, [tuple(row) for row in result.collect()])
    names, rows = sql_rows(contract.oracle_sql()[name], sf_dir)
    if sorted(names) != sorted(result.columns):
        return len(ours), f"columns {sorted(result.columns)} and {sorted(names)}"
    theirs = comparable(names, rows)
    if ours == theirs:
        return len(ours), None
    pairs = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return len(ours), f"{len(ours)} and {len(theirs)} rows, first differing: {pairs[0] if pairs else None}"


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[2:] or contract.oracle_sql():
        begin = time.time()
        try:
            count, wrong = difference(spark, name, sf_dir)
            print(f"{name:30} {count:8} rows {time.time() - begin:6.2f} s {wrong or 'equal'}", flush=True)
        except Exception as error:
            print(f"{name:30} FAILED {str(error)[:1500]}", flush=True)
