"""Run registered queries and their SQL side by side: ``python -m checks.compare [sf] [key prefix ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import oracle_sql
from checks.queries import queries

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TEST_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "<null>"
    if isinstance(value, float):
        return repr(value)
    return str(value)


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> str:
    """Empty when both agree, else what differs."""
    df = queries()[name](spark, sf_dir)
    left = canonical(df.columns, [tuple(r) for r in df.collect()])
    relation = con.sql(oracle_sql()[name])
    right = canonical(relation.columns, relation.fetchall())
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} / {sorted(relation.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    if left != right:
        wrong = [(a, b) for a, b in zip(left, right) if a != b]
        return f"{len(wrong)} values differ, first {wrong[0]}"
    if not left:
        return "no rows at all"
    types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    odd = {f.name: (f.dataType.simpleString(), types[f.name]) for f in df.schema.fields if not _same_type(f.dataType.simpleString(), types[f.name])}
    return f"types {odd}" if odd else ""


SAME_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def _same_type(spark_type: str, duck_type: str) -> bool:
    return SAME_TYPES.get(spark_type, spark_type) == duck_type


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "0.01"
    prefixes = tuple(argv[1:])
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in queries():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'BAD' if problem else 'ok '} {name:24s} {time.time() - start:6.2f}s {problem}", flush=True)
    print("missing oracle:", sorted(set(queries()) - set(oracle_sql())), "extra:", sorted(set(oracle_sql()) - set(queries())))
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
