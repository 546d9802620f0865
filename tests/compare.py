"""Runs every check on both engines and reports differences: `python -m tests.compare [sf_dir] [name ...]`."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def ordered(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    place = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = [tuple(row[i] for i in place) for row in rows]
    return [columns[i] for i in place], sorted(shown, key=lambda r: [(v is not None, str(type(v)), v) for v in r])


_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a Spark result and a SQL result, types included; None if nothing does."""
    left_columns, left = ordered(spark_df.columns, spark_df.collect())
    cursor = con.execute(sql)
    kinds = {column[0]: str(column[1]) for column in cursor.description}
    right_columns, right = ordered([c[0] for c in cursor.description], cursor.fetchall())
    if left_columns != right_columns:
        return f"columns {left_columns} != {right_columns}"
    for field in spark_df.schema.fields:
        if _KINDS.get(field.dataType.simpleString()) != kinds[field.name]:
            return f"type of {field.name}: {field.dataType.simpleString()} != {kinds[field.name]}"
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    for one, other in zip(left, right):
        if one != other:
            return f"row {one} != {other}"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as spec

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = set(argv[1:])
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), spec.oracle_sql(), 0
    for name, query in spec.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sqls:
                found = difference(query(spark, sf_dir), con, sqls[name])
            else:
                found = None if query(spark, sf_dir).count() >= 0 else "no rows"
        except Exception as error:  # report and go on with the next check
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    print(f"{bad} of {len(spec.queries())} differ")
    return int(bad > 0)


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
