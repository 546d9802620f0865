"""Visa purpose and category."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions.codes import UNKNOWN

# Purpose of each visa type.
PURPOSES = {
    "B1": "Business",
    "B2": "Tourism/Pleasure",
    "WT": "Visa Waiver Tourist",
    "WB": "Visa Waiver Business",
    "F1": "Student",
    "M1": "Vocational Student",
    "J1": "Exchange Visitor",
    "H1B": "Work - Specialty Occupation",
    "H2A": "Work - Agricultural",
    "H2B": "Work - Non-agricultural",
    "L1": "Intracompany Transferee",
    "E1": "Treaty Trader",
    "E2": "Treaty Investor",
    "CP": "Crewmember",
    "GMT": "Global Entry Mexico",
    "I": "Journalist",
    "Unknown": "Unknown",
}
OTHER = "Other"

# Category of each visa class.
CATEGORIES = {1: "Business", 2: "Pleasure", 3: "Student"}


def _literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(part) for item in values.items() for part in item])


def visa_purpose(visa_type: Column) -> Column:
    """Purpose of a visa type: missing gives 'Unknown', a type not listed gives 'Other'."""
    listed = F.try_element_at(_literal_map(PURPOSES), visa_type)
    return F.when(visa_type.isNull(), F.lit(UNKNOWN)).otherwise(F.coalesce(listed, F.lit(OTHER)))


def visa_category(visa_class: Column) -> Column:
    """Category of a visa class, null for any class not listed (1.5 is not class 1)."""
    number = visa_class.try_cast("double")
    return F.try_element_at(_literal_map({float(k): v for k, v in CATEGORIES.items()}), number)


def refine_purpose(purpose: Column, category: Column) -> Column:
    """Let a known category stand in for 'Other'; without one the purpose is 'Unknown'."""
    return F.when(purpose == OTHER, F.coalesce(category, F.lit(UNKNOWN))).otherwise(purpose)
