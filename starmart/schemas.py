"""Input columns, table names and layouts. All of these are fixed values of the data contract."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw arrivals: the columns the job reads. Files may hold more; columns may be absent.
ARRIVALS = T.StructType(
    [
        T.StructField("cicid", T.DoubleType()),
        T.StructField("i94cit", T.DoubleType()),
        T.StructField("i94res", T.DoubleType()),
        T.StructField("i94port", T.StringType()),
        T.StructField("arrdate", T.DoubleType()),
        T.StructField("depdate", T.DoubleType()),
        T.StructField("i94mode", T.DoubleType()),
        T.StructField("i94bir", T.DoubleType()),
        T.StructField("biryear", T.DoubleType()),
        T.StructField("gender", T.StringType()),
        T.StructField("visatype", T.StringType()),
        T.StructField("visapost", T.StringType()),
        T.StructField("i94visa", T.DoubleType()),
    ]
)

LOOKUP = T.StructType([T.StructField("code", T.StringType()), T.StructField("description", T.StringType())])

# Lookup names: file stems, and block names of the value-format catalog.
COUNTRY = "i94cntyl"
PORT = "i94prtl"
MODE = "i94model"
STATE = "i94addrl"
VISA = "i94visa"
LOOKUPS = (COUNTRY, PORT, MODE, STATE)
REQUIRED_LOOKUPS = (COUNTRY, MODE, PORT)

# Output tables.
FACT = "fact_immigration"
DIM_DATE = "dim_date"
DIM_VISITOR = "dim_visitor"
DIM_VISA = "dim_visa"
DIM_PORT = "dim_port"
REJECTED = "rejected_immigration_records"
SUMMARY = "rejection_summary"
METRICS = "quality_metrics"
SKIPPED_FILES = "skipped_files"

FACT_COLUMNS = (
    "visitor_id",
    "arrival_date_id",
    "departure_date_id",
    "port_code",
    "visatype",
    "travel_mode",
    "is_overstay",
)
VISITOR_COLUMNS = (
    "visitor_id",
    "country_of_citizenship",
    "country_of_citizenship_code",
    "country_of_residence",
    "country_of_residence_code",
    "age",
    "gender",
    "biryear",
)
VISA_COLUMNS = ("visa_code", "visa_issuing_post", "visa_purpose", "visa_category")
PORT_COLUMNS = ("port_code", "port_of_entry", "city", "state", "country_code")
QUARANTINE_COLUMNS = (
    "original_record",
    "is_rejected",
    "rejection_reason",
    "rejection_timestamp",
    "source_file",
    "rejection_id",
)
