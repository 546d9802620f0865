"""Derived columns of an arrival: dates, ids, travel mode, overstay flag, lookup hits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart import schemas
from starmart.functions import codes, dates
from starmart.operators.joins import attach, attach_all, described
from starmart.sources.lookups import Lookups

DATES = (("arrdate", "arrdate_dt", "arrival_date_id"), ("depdate", "depdate_dt", "departure_date_id"))

# Lookup hits the rules need: column, lookup, name of the joined description.
HITS = (
    ("i94port", schemas.PORT, "port_name"),
    ("i94cit", schemas.COUNTRY, "citizenship_name"),
    ("i94res", schemas.COUNTRY, "residence_name"),
)
HIT_COLUMNS = tuple(column for _, _, name in HITS for column in (name, f"{name}_known"))


def with_dates(df: DataFrame) -> DataFrame:
    """Dates and integer date ids of the day numbers at hand."""
    for number, date, key in DATES:
        if number in df.columns:
            df = df.withColumn(date, dates.day_number_to_date(F.col(number)))
            df = df.withColumn(key, dates.date_id(F.col(date)))
    return df


def with_overstay(df: DataFrame) -> DataFrame:
    """A missing departure marks a possible overstay."""
    if {"arrdate_dt", "depdate_dt"} <= set(df.columns):
        df = df.withColumn("is_overstay", F.col("depdate_dt").isNull())
    return df


VISA_MISSING = "visa_type_missing"


def with_visa_type(df: DataFrame) -> DataFrame:
    """Missing visa types become 'Unknown'; which ones were missing stays on record."""
    if "visatype" in df.columns:
        df = df.withColumn(VISA_MISSING, F.col("visatype").isNull())
        df = df.withColumn("visatype", F.coalesce("visatype", F.lit(codes.UNKNOWN)))
    return df


def with_travel_mode(df: DataFrame, lookups: Lookups) -> DataFrame:
    """Name of the travel mode, 'Unknown' when the code is missing or not listed."""
    if "i94mode" in df.columns and schemas.MODE in lookups:
        df = attach(df, "i94mode", lookups[schemas.MODE], "mode_name")
        mode = described(F.col("mode_name"), F.col("mode_name_known"), F.lit(codes.UNKNOWN))
        df = df.withColumn("travel_mode", mode).drop("mode_name", "mode_name_known")
    return df


def with_hits(df: DataFrame, lookups: Lookups) -> DataFrame:
    """Whether port and country codes are in their lookups, as `<name>_known`, with the texts found."""
    return attach_all(df, [(code, lookups[lookup], name) for code, lookup, name in HITS if code in df.columns and lookup in lookups])


def enrich(df: DataFrame, lookups: Lookups) -> DataFrame:
    """Everything the rules and the star tables need; steps without their column or lookup are left out."""
    return with_hits(with_travel_mode(with_visa_type(with_overstay(with_dates(df))), lookups), lookups)
