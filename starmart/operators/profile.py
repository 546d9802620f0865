"""Profiles of a table: missing values, distributions, ranges, domains, histograms.

Each is one pass with partial aggregation. Shares divide by a scalar subquery over the same counts, so no total
goes through the driver and nothing is joined to everything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import codes, dates
from starmart.functions.codes import is_missing
from starmart.operators.joins import attach, unmapped
from starmart.operators.quantiles import exact_quantiles, quantile_values


def _count() -> Column:
    return F.count(F.lit(1))


def nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column, as count and percent of all rows; the emptiest column comes first."""
    names = list(columns or df.columns)
    counted = df.agg(_count().alias("_rows"), *[F.count_if(is_missing(df, c)).alias(c) for c in names])
    long = counted.unpivot(["_rows"], names, "column", "missing")
    percent = (F.col("missing") * 100 / F.col("_rows")).alias("missing_percent")
    return long.select("column", "missing", percent).orderBy(F.desc("missing_percent"), "column")


def mostly_missing(profile: DataFrame, percent: float = 0.5) -> DataFrame:
    """Columns of a null profile with more than the given percent missing."""
    return profile.where(F.col("missing_percent") > percent)


def value_counts(df: DataFrame, column: str, missing_as: str | None = None) -> DataFrame:
    """Rows per value. Missing values are left out, or counted under the label `missing_as`."""
    if missing_as is None:
        rows = df.where(~is_missing(df, column)).groupBy(column)
    else:
        label = F.when(is_missing(df, column), F.lit(missing_as)).otherwise(F.col(column).cast("string"))
        rows = df.groupBy(label.alias(column))
    return rows.agg(_count().alias("count"))


def with_percent(counts: DataFrame) -> DataFrame:
    """Add each count's percentage of the sum of all counts."""
    total = counts.select(F.sum("count")).scalar()
    return counts.withColumn("percentage", F.col("count") * 100 / total)


def with_names(counts: DataFrame, column: str, lookup: DataFrame, into: str) -> DataFrame:
    """Add the lookup's text for each value, null where it has none."""
    return attach(counts, column, lookup, into).drop(f"{into}_known")


def top(counts: DataFrame, k: int, by: str = "count") -> DataFrame:
    """The k largest; equal counts go by the first column, so the result does not vary."""
    key = next(c for c in counts.columns if c != by)
    return counts.orderBy(F.desc(by), key).limit(k)


def date_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Earliest and latest date per column."""
    bounds = df.agg(*[F.struct(F.min(c).alias("min"), F.max(c).alias("max")).alias(c) for c in columns])
    return bounds.unpivot([], list(columns), "column", "bounds").select("column", "bounds.min", "bounds.max")


QUARTILES = (0.25, 0.5, 0.75)


def describe(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles, maximum of the numbers in a column.

    Quartiles are exact and interpolated; `approximate` takes them from a sketch in the same pass.
    """
    value = codes.to_number(F.col(column))
    numbers = df.select(value.alias("v")).where("v is not null and not isnan(v)")
    basics = [
        F.count("v").alias("count"),
        F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    ]
    if approximate:
        sketch = F.percentile_approx("v", list(QUARTILES), 10_000).alias("q")
        numbers = numbers.agg(*basics, sketch)
        quartiles = [F.get("q", F.lit(i)) for i in range(len(QUARTILES))]
    else:
        points = exact_quantiles(numbers, "v", QUARTILES).first()
        numbers = numbers.agg(*basics)
        quartiles = [F.lit(point).cast("double") for point in points]
    named = [q.alias(f"p{round(p * 100)}") for q, p in zip(quartiles, QUARTILES)]
    return numbers.select(F.lit(column).alias("column"), "count", "mean", "std", "min", *named, "max")


def describe_all(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`describe` of several columns, a row each: one pass for the basics and a few for all quartiles together."""
    values = {c: codes.to_number(F.col(c)) for c in columns}
    numbers = df.select(*[F.when(~F.isnan(v), v).alias(c) for c, v in values.items()])
    points = quantile_values(numbers, columns, QUARTILES)
    rows = []
    for c, found in zip(columns, points):
        v = F.col(f"`{c}`")
        basics = [F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min")]
        quartiles = [F.lit(point).cast("double").alias(f"p{round(p * 100)}") for point, p in zip(found, QUARTILES)]
        rows.append(F.struct(F.lit(c).alias("column"), *basics, *quartiles, F.max(v).alias("max")))
    return numbers.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def sentinels(df: DataFrame, column: str, values: Sequence[float] = (-999, -1, 0, 999)) -> DataFrame:
    """Rows that hold each of the values which may stand for 'missing'."""
    number = codes.to_number(F.col(column))
    names = [str(v) for v in values]
    counted = df.agg(*[F.count_if(number == v).alias(n) for v, n in zip(values, names)])
    return counted.unpivot([], names, "value", "rows")


def distinct_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """How many different values there are, missing counting as one, and the n smallest of them."""
    values = df.select(F.when(~is_missing(df, column), F.col(column)).alias("value")).distinct()
    total = values.select(_count()).scalar()
    return values.where("value is not null").orderBy("value").limit(n).withColumn("distinct_values", total)


def approx_distinct(df: DataFrame, column: str) -> DataFrame:
    """Estimated number of different values, missing ones left out; needs no shuffle of values."""
    return df.agg(F.approx_count_distinct(column).alias("distinct_values"))


def non_numeric(df: DataFrame, column: str) -> DataFrame:
    """Rows with a value that is no number."""
    number = codes.to_number(F.col(column))
    return df.agg(F.count_if(~is_missing(df, column) & number.isNull()).alias("non_numeric"))


STATUS_VALID, STATUS_MISSING, STATUS_INVALID = "Valid", "NA/Missing", "Invalid"


def domain_status(df: DataFrame, column: str, allowed: Sequence) -> Column:
    """Whether a value is allowed, missing or neither."""
    return (
        F.when(is_missing(df, column), F.lit(STATUS_MISSING))
        .when(F.col(column).isin(*allowed), F.lit(STATUS_VALID))
        .otherwise(F.lit(STATUS_INVALID))
    )


def domain_values(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Rows per value, each marked valid, missing or invalid."""
    return df.groupBy(domain_status(df, column, allowed).alias("status"), F.col(column).alias("value")).agg(
        _count().alias("count")
    )


def domain_check(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Valid, missing and invalid rows, as count and percent of all; a status without rows counts 0."""
    status = domain_status(df, column, allowed)
    states = (STATUS_VALID, STATUS_MISSING, STATUS_INVALID)
    counted = df.agg(_count().alias("_rows"), *[F.count_if(status == s).alias(s) for s in states])
    long = counted.unpivot(["_rows"], list(states), "status", "count")
    return long.select("status", "count", (F.col("count") * 100 / F.col("_rows")).alias("percentage"))


def histogram(
    df: DataFrame, column: str, bins: int, lo: float | None = None, hi: float | None = None, open_lo: bool = False
) -> DataFrame:
    """Counts in equal bins between the smallest and largest value within lo..hi, empty bins included.

    Both ends count unless `open_lo` leaves out lo itself. The largest value falls into the last bin.
    """
    value = codes.to_number(F.col(column))
    numbers = df.select(value.alias("v")).where("v is not null and not isnan(v)")
    if lo is not None:
        numbers = numbers.where(F.col("v") > lo if open_lo else F.col("v") >= lo)
    if hi is not None:
        numbers = numbers.where(F.col("v") <= hi)
    # Each task hands on the ends of the range, then a count per bin: the values themselves stay where they are.
    ends = numbers.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high"))).scalar()
    low, width = F.col("ends.low"), (F.col("ends.high") - F.col("ends.low")) / bins
    place = F.when(width > 0, F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    filled = (
        numbers.withColumn("ends", ends).groupBy(place.cast("int").alias("bin")).agg(_count().alias("count"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), ends.alias("ends"))
    return every.join(F.broadcast(filled), "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("from"),
        (low + (F.col("bin") + 1) * width).alias("to"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
    )


def stays(df: DataFrame) -> DataFrame:
    """Arrivals whose dates are both known, with their stay in days."""
    days = dates.stay_days(F.col("arrdate_dt"), F.col("depdate_dt"))
    return df.withColumn("stay_days", days).where("stay_days is not null")


def wrong_order(df: DataFrame) -> DataFrame:
    """Rows that leave before they arrive."""
    return df.where("depdate_dt < arrdate_dt")


def not_in_lookup(df: DataFrame, column: str, lookup: DataFrame) -> DataFrame:
    """Rows whose code is present but not in the lookup."""
    return unmapped(df, column, lookup)


NAME_MISSING = "NA"


def with_country_name(df: DataFrame, column: str, lookup: DataFrame, into: str = "country_name") -> DataFrame:
    """Country name for reading: 'NA' when missing, 'Unknown (148)' when not listed, else the bad value named."""
    number = F.col("_number")
    named = attach(df.withColumn("_number", F.col(column).try_cast("bigint")), "_number", lookup, "_name")
    label = (
        F.when(is_missing(df, column), F.lit(NAME_MISSING))
        .when(F.col("_name_known"), F.col("_name"))
        .when(number.isNotNull(), F.format_string("Unknown (%d)", number))
        .otherwise(F.format_string("Invalid code format (%s)", F.col(column).cast("string")))
    )
    return named.withColumn(into, label).drop("_number", "_name", "_name_known")


def mapping_totals(df: DataFrame, column: str, lookup: DataFrame) -> DataFrame:
    """Rows without a code, with an unlisted code, and all rows."""
    hit = attach(df, column, lookup, "_name")
    missing = is_missing(df, column)
    return hit.agg(
        _count().alias("rows"),
        F.count_if(missing).alias("na_values"),
        F.count_if(~missing & ~F.col("_name_known")).alias("unknown_codes"),
    )
