"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\r\n\f\v"


def strip(text: Column) -> Column:
    """Text without outer blanks, tabs and line ends."""
    return F.btrim(text, F.lit(BLANKS))
