from __future__ import annotations

import math
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions import bands, codes, dates, places, visas


def column(spark, values, kind, expression):
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("x", kind)])
    rows = spark.createDataFrame(list(enumerate(values)), schema)
    return [r.y for r in rows.select("i", expression(rows).alias("y")).orderBy("i").collect()]


def test_day_numbers(spark):
    values = [None, math.nan, math.inf, -math.inf, 1e12, -1.9, 0.0, 20573.0, 20573.9, 2936549.0, 2936550.0, -715509.0, -715510.0]
    got = column(spark, values, T.DoubleType(), lambda df: dates.day_number_to_date(F.col("x")))
    assert got == [
        None, None, None, None, None, date(1959, 12, 31), date(1960, 1, 1), date(2016, 4, 29), date(2016, 4, 29),
        date(9999, 12, 31), None, date(1, 1, 1), None,
    ]


def test_day_numbers_as_text(spark):
    got = column(spark, ["20573", "20573.0", "", None], T.StringType(), lambda df: dates.day_number_to_date(F.col("x")))
    assert got == [date(2016, 4, 29), None, None, None]


def test_date_id(spark):
    got = column(spark, [date(2016, 4, 9), None], T.DateType(), lambda df: dates.date_id(F.col("x")))
    assert got == [20160409, None]


@pytest.mark.parametrize(
    "kind, values, expected",
    [
        (T.DoubleType(), [148.0, 148.9, -1.0, None, math.nan, math.inf, 0.0], ["148", "148", "-1", None, None, None, "0"]),
        (T.StringType(), ["148", "148.0", None, "P1 "], ["148", "148.0", None, "P1 "]),
        (T.LongType(), [148, None], ["148", None]),
    ],
)
def test_code_of(spark, kind, values, expected):
    assert column(spark, values, kind, lambda df: codes.code_of(df, "x")) == expected


def test_missing_is_null_or_nan(spark):
    got = column(spark, [1.0, None, math.nan, math.inf], T.DoubleType(), lambda df: codes.is_missing(df, "x"))
    assert got == [False, True, True, False]


def test_whole_numbers(spark):
    got = column(spark, ["5", "5.0", "x", None], T.StringType(), lambda df: codes.to_whole(df, "x", "bigint"))
    assert got == [5, 5, None, None]
    big = 3_000_000_000.0
    assert column(spark, [big, math.nan], T.DoubleType(), lambda df: codes.to_whole(df, "x", "bigint")) == [3_000_000_000, None]


def test_age_bands(spark):
    ages = [None, -1.0, 0.0, 24.0, 25.0, 34.9, 45.0, 54.0, 55.0, 101.0]
    got = column(spark, ages, T.DoubleType(), lambda df: bands.age_band(F.col("x")))
    assert got == ["55+", "18-24", "18-24", "18-24", "25-34", "25-34", "45-54", "45-54", "55+", "55+"]
    got = column(spark, [None, math.nan, -1.0, 0.0, 20.0, 20.5, 100.0, 101.0], T.DoubleType(), lambda df: bands.profile_age_band(F.col("x")))
    assert got == ["NA", "NA", "Negative", "0-20", "0-20", "21-40", "81-100", "100+"]


def test_visa_purpose_and_category(spark):
    got = column(spark, ["B1", "GMT", "X9", None, "Unknown"], T.StringType(), lambda df: visas.visa_purpose(F.col("x")))
    assert got == ["Business", "Global Entry Mexico", "Other", "Unknown", "Unknown"]
    got = column(spark, [1.0, 2.0, 3.0, 4.0, 1.5, None], T.DoubleType(), lambda df: visas.visa_category(F.col("x")))
    assert got == ["Business", "Pleasure", "Student", None, None, None]


def test_purpose_override(spark):
    rows = spark.createDataFrame([("Other", "Student"), ("Other", None), ("Business", "Student")], "p string, c string")
    got = [r.y for r in rows.select(visas.refine_purpose(F.col("p"), F.col("c")).alias("y")).collect()]
    assert got == ["Student", "Unknown", "Business"]


def test_place_parts(spark):
    got = column(
        spark,
        ["ALCAN, AK", "TOWN", "PASS, OLD ROAD, CA", "TOWN,", " TOWN ,\tAK ", None],
        T.StringType(),
        lambda df: places.place_parts(F.col("x")),
    )
    assert [tuple(r) for r in got] == [
        ("ALCAN", "AK", "US"),
        ("TOWN", "Unknown", "US"),
        ("PASS", "OLD ROAD", "US"),
        ("TOWN", "", "US"),
        ("TOWN", "AK", "US"),
        (None, "Unknown", "US"),
    ]
