"""Code columns: one text form for numeric and textual codes, and tests for missing values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRACTIONAL = (T.DoubleType, T.FloatType)

UNKNOWN = "Unknown"  # fixed value: label of a missing or unmapped code


def is_missing(df: DataFrame, name: str) -> Column:
    """True for null, and for NaN in floating point columns."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, FRACTIONAL):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def norm_code(code: Column, dtype: T.DataType) -> Column:
    """The text a code is looked up by: 148, 148.0 and '148' all give '148'; text stays as it is."""
    if isinstance(dtype, T.StringType):
        return code
    if isinstance(dtype, T.NumericType):
        return code.try_cast("bigint").cast("string")
    return code.cast("string")


def code_of(df: DataFrame, name: str) -> Column:
    return norm_code(F.col(name), df.schema[name].dataType)


def to_number(column: Column) -> Column:
    """Number of a value, null where it is none."""
    return column.try_cast("double")


def to_date(column: Column) -> Column:
    """Date of a value, null where it is none."""
    return column.try_cast("date")


def to_whole(df: DataFrame, name: str, dtype: str) -> Column:
    """A column as whole numbers, null where it holds none; text such as '5.0' counts."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.coalesce(column.try_cast(dtype), to_number(column).try_cast(dtype))
    return column.try_cast(dtype)
