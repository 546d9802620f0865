"""Table writers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

FORMATS = ("parquet", "csv")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None) -> int:
    """Overwrite `path` with the table and tell how many rows went there, without a second job."""
    return write_observed(df, path, fmt, partition_by)["rows"]


def write_observed(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None, totals: Mapping[str, Column] | None = None
) -> dict[str, int]:
    """Overwrite `path` with the table; `rows` and the other totals are taken of the rows as they are written.

    With `partition_by` the rows are rebalanced on that column first, which gives files of an even size: small
    values share a task and a value that holds most rows is spread over many.
    """
    if fmt.lower() not in FORMATS:
        raise ValueError(f"format {fmt!r} is none of {', '.join(FORMATS)}")
    rows = Observation()
    if partition_by is not None:
        df = df.hint("rebalance", partition_by)
    more = [value.alias(name) for name, value in (totals or {}).items()]
    writer = df.observe(rows, F.count(F.lit(1)).alias("rows"), *more).write.mode("overwrite")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    if fmt.lower() == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
    return {name: value or 0 for name, value in rows.get.items()}

