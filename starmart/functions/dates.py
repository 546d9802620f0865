"""Day numbers, dates and integer date ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day numbers count from this date; the range covers years 1 to 9999.
BASE_DATE = "1960-01-01"
FIRST_DAY = -715509
LAST_DAY = 2936549


def day_number_to_date(day: Column) -> Column:
    """Date of a day number. Fractions truncate toward zero; what is no usable number gives null."""
    whole = day.try_cast("int")
    base = F.lit(BASE_DATE).cast("date")
    return F.when(whole.between(FIRST_DAY, LAST_DAY), F.date_add(base, whole))


def date_id(date: Column) -> Column:
    """A date as the integer yyyymmdd."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def stay_days(arrival: Column, departure: Column) -> Column:
    """Whole days between arrival and departure; null unless both are known."""
    return F.datediff(departure, arrival)
