"""Fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart import schemas
from starmart.functions import codes

RENAMED = {"visitor_id": "cicid", "port_code": "i94port"}


def arrivals(clean: DataFrame) -> DataFrame:
    """One row per clean arrival, with the fact columns whose sources are there. A projection: nothing moves."""
    columns = []
    for target in schemas.FACT_COLUMNS:
        source = RENAMED.get(target, target)
        if source in clean.columns:
            column = codes.to_whole(clean, source, "bigint") if target == "visitor_id" else F.col(source)
            columns.append(column.alias(target))
    if not columns:
        raise ValueError("none of the fact columns is in the data")
    return clean.select(*columns)
