"""Parts of a port description such as 'ALCAN, AK'."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions.codes import UNKNOWN
from starmart.functions.text import strip

COUNTRY = "US"  # fixed value: every port of entry lies in this country


def place_parts(text: Column) -> Column:
    """Struct (city, state, country_code); the state is the second comma part, if there is one."""
    parts = F.split(text, ",")
    return F.struct(
        strip(F.get(parts, F.lit(0))).alias("city"),
        F.coalesce(strip(F.get(parts, F.lit(1))), F.lit(UNKNOWN)).alias("state"),
        F.lit(COUNTRY).alias("country_code"),
    )
