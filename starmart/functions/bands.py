"""Age bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exclusive upper ages of the report bands; what is left, a missing age included, is OLDEST.
REPORT_BANDS = ((25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"))
OLDEST = "55+"

# Inclusive upper ages of the profile bands.
PROFILE_BANDS = ((20, "0-20"), (40, "21-40"), (60, "41-60"), (80, "61-80"), (100, "81-100"))
PROFILE_MISSING, PROFILE_NEGATIVE, PROFILE_ABOVE = "NA", "Negative", "100+"


def age_band(age: Column) -> Column:
    """Band used by the overstay report."""
    band = F.lit(OLDEST)
    for below, label in reversed(REPORT_BANDS):
        band = F.when(age < below, F.lit(label)).otherwise(band)
    return band


def profile_age_band(age: Column) -> Column:
    """Band used by the age profile: also names missing, negative and very high ages."""
    band = F.lit(PROFILE_ABOVE)
    for upto, label in reversed(PROFILE_BANDS):
        band = F.when(age <= upto, F.lit(label)).otherwise(band)
    return (
        F.when(age.isNull() | F.isnan(age.cast("double")), F.lit(PROFILE_MISSING))
        .when(age < 0, F.lit(PROFILE_NEGATIVE))
        .otherwise(band)
    )
