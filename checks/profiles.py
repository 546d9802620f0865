"""Profiles and top lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.columns import PROFILE_BAND
from checks.registry import check, rounded, texts
from starmart.functions import bands
from starmart.operators import dims, profile

_VISITOR_COUNTRY = """
SELECT COALESCE(description, 'Unknown') AS {alias}, count(*) AS count
FROM clean LEFT JOIN lk_country ON CAST(CAST({code} AS BIGINT) AS VARCHAR) = code GROUP BY 1
"""


def _country_check(code: str, alias: str) -> None:
    sql = _VISITOR_COUNTRY.format(code=code, alias=alias)

    def counts(d):
        named = dims.with_country(d.clean, code, d.lookups["i94cntyl"], alias)
        return profile.value_counts(named, alias)

    check(f"a2_{alias}", sql)(counts)
    check(f"t1_top10_{alias}", f"SELECT * FROM ({sql}) ORDER BY count DESC, {alias} LIMIT 10")(
        lambda d: profile.top(counts(d), 10)
    )


_country_check("i94cit", "country_of_citizenship")
_country_check("i94res", "country_of_residence")


@check("a6_age_bands", f"SELECT {PROFILE_BAND} AS age_group, count(*) AS count FROM arrivals GROUP BY 1")
def _(d):
    banded = d.arrivals.select(bands.profile_age_band(F.col("i94bir")).alias("age_group"))
    return profile.value_counts(banded, "age_group")


@check(
    "a6_age_outliers",
    """
SELECT count(*) FILTER (i94bir < 0) AS negative_ages, count(*) FILTER (i94bir > 100) AS extreme_ages FROM arrivals
""",
)
def _(d):
    return d.arrivals.agg(
        F.count_if(F.col("i94bir") < 0).alias("negative_ages"), F.count_if(F.col("i94bir") > 100).alias("extreme_ages")
    )


_PORT_COUNTS = """
SELECT i94port, count, round(count * 100.0 / (SELECT count(i94port) FROM arrivals), 6) AS percentage,
       description AS port_name
FROM (SELECT i94port, count(*) AS count FROM arrivals WHERE i94port IS NOT NULL GROUP BY i94port)
LEFT JOIN lk_port ON i94port = code
"""


def _port_counts(d):
    counts = profile.with_percent(profile.value_counts(d.arrivals, "i94port"))
    return rounded(profile.with_names(counts, "i94port", d.lookups["i94prtl"], "port_name"), "percentage")


check("a7_port_counts", _PORT_COUNTS)(_port_counts)
check("t1_top10_ports", f"SELECT * FROM ({_PORT_COUNTS}) ORDER BY count DESC, i94port LIMIT 10")(
    lambda d: profile.top(_port_counts(d), 10)
)


_INVALID_PORTS = """
SELECT i94port, count(*) AS count FROM arrivals
WHERE i94port IS NOT NULL AND i94port NOT IN (SELECT code FROM lk_port) GROUP BY i94port
"""


def _invalid_ports(d):
    return profile.value_counts(profile.not_in_lookup(d.arrivals, "i94port", d.lookups["i94prtl"]), "i94port")


check("a8_invalid_ports", _INVALID_PORTS)(_invalid_ports)
check("t1_top10_invalid_ports", f"SELECT * FROM ({_INVALID_PORTS}) ORDER BY count DESC, i94port LIMIT 10")(
    lambda d: profile.top(_invalid_ports(d), 10)
)


@check("a8_gender", "SELECT COALESCE(gender, 'NA') AS gender, count(*) AS count FROM arrivals GROUP BY 1")
def _(d):
    return profile.value_counts(d.arrivals, "gender", missing_as=profile.NAME_MISSING)


_COUNTRY_NAMES = """
SELECT CASE WHEN i94cit IS NULL THEN 'NA' WHEN description IS NOT NULL THEN description
            ELSE CONCAT('Unknown (', CAST(CAST(i94cit AS BIGINT) AS VARCHAR), ')') END AS country_name,
       count(*) AS count
FROM arrivals LEFT JOIN lk_country ON CAST(CAST(i94cit AS BIGINT) AS VARCHAR) = code GROUP BY 1
"""


def _country_names(d):
    named = profile.with_country_name(d.arrivals, "i94cit", d.lookups["i94cntyl"])
    return profile.value_counts(named, "country_name")


check("a8_country_names", _COUNTRY_NAMES)(_country_names)
check("t1_top15_countries", f"SELECT * FROM ({_COUNTRY_NAMES}) ORDER BY count DESC, country_name LIMIT 15")(
    lambda d: profile.top(_country_names(d), 15)
)


_UNMAPPED = """
SELECT i94cit, count(*) AS count FROM arrivals
WHERE i94cit IS NOT NULL AND CAST(CAST(i94cit AS BIGINT) AS VARCHAR) NOT IN (SELECT code FROM lk_country)
GROUP BY i94cit
"""


def _unmapped(d):
    return profile.value_counts(profile.not_in_lookup(d.arrivals, "i94cit", d.lookups["i94cntyl"]), "i94cit")


check("a8_unmapped_codes", _UNMAPPED)(_unmapped)
check("t1_top5_unmapped_codes", f"SELECT * FROM ({_UNMAPPED}) ORDER BY count DESC, i94cit LIMIT 5")(
    lambda d: profile.top(_unmapped(d), 5)
)


_COLUMNS = (
    "cicid i94cit i94res i94port arrdate depdate i94mode i94bir biryear gender visatype visapost i94visa".split()
)


def _null_profile(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, "
        f"round((count(*) - count({c})) * 100.0 / count(*), 6) AS missing_percent FROM arrivals"
        for c in columns
    )


@check("a9_null_profile", _null_profile(_COLUMNS))
def _(d):
    return rounded(profile.nulls(d.arrivals), "missing_percent")


@check("p28_columns_with_gaps", f"SELECT * FROM ({_null_profile(_COLUMNS)}) WHERE missing_percent > 0.5")
def _(d):
    return rounded(profile.mostly_missing(profile.nulls(d.arrivals), 0.5), "missing_percent")


@check("a12_missing_share", _null_profile(["i94bir", "gender", "i94cit"]))
def _(d):
    return rounded(profile.nulls(d.arrivals, ["i94bir", "gender", "i94cit"]), "missing_percent")


@check(
    "a10_date_range",
    """
SELECT 'arrdate_dt' AS "column", CAST(min(arrdate_dt) AS VARCHAR) AS min, CAST(max(arrdate_dt) AS VARCHAR) AS max
FROM enriched
UNION ALL SELECT 'depdate_dt', CAST(min(depdate_dt) AS VARCHAR), CAST(max(depdate_dt) AS VARCHAR) FROM enriched
""",
)
def _(d):
    return texts(profile.date_range(d.enriched, ["arrdate_dt", "depdate_dt"]), "min", "max")


def _summary(column: str, table: str) -> str:
    return f"""
SELECT '{column}' AS "column", count({column}) AS count, round(avg({column}), 6) AS mean,
       round(stddev_samp({column}), 6) AS std, CAST(min({column}) AS DOUBLE) AS min,
       round(quantile_cont(CAST({column} AS DOUBLE), 0.25), 6) AS p25,
       round(quantile_cont(CAST({column} AS DOUBLE), 0.5), 6) AS p50,
       round(quantile_cont(CAST({column} AS DOUBLE), 0.75), 6) AS p75, CAST(max({column}) AS DOUBLE) AS max
FROM {table}
"""


@check("a11_stay_summary", _summary("stay_days", "stays"))
def _(d):
    return rounded(profile.describe(profile.stays(d.enriched), "stay_days"), "mean", "std", "p25", "p50", "p75")


@check("a11_age_summary", _summary("i94bir", "arrivals"))
def _(d):
    return rounded(profile.describe(d.arrivals, "i94bir"), "mean", "std", "p25", "p50", "p75")


_NUMBERS = ("cicid", "i94cit", "i94res", "arrdate", "depdate", "i94mode", "i94bir", "biryear", "i94visa")


@check("a11_all_columns", " UNION ALL ".join(_summary(c, "arrivals") for c in _NUMBERS))
def _(d):
    return rounded(profile.describe_all(d.arrivals, _NUMBERS), "mean", "std", "p25", "p50", "p75")


@check("a11_price_summary", _summary("o_totalprice", "orders"))
def _(d):
    """A column with nearly as many values as rows."""
    prices = d.spark.read.parquet(f"{d.sf_dir}/orders.parquet")
    return rounded(profile.describe(prices, "o_totalprice"), "mean", "std", "p25", "p50", "p75")


@check(
    "a13_sentinels",
    """
SELECT value, count(*) FILTER (i94cit = CAST(value AS DOUBLE)) AS rows
FROM arrivals, (VALUES ('-999'), ('-1'), ('0'), ('999')) s(value) GROUP BY value
""",
)
def _(d):
    return profile.sentinels(d.arrivals, "i94cit")


@check(
    "a14_distinct_values",
    """
SELECT value, (SELECT count(*) FROM (SELECT DISTINCT i94cit FROM arrivals)) AS distinct_values
FROM (SELECT DISTINCT i94cit AS value FROM arrivals WHERE i94cit IS NOT NULL ORDER BY value LIMIT 10)
""",
)
def _(d):
    return profile.distinct_values(d.arrivals, "i94cit", 10)


@check(
    "a15_non_numeric",
    """
SELECT count(*) FILTER (i94port IS NOT NULL AND TRY_CAST(substr(i94port, 2) AS DOUBLE) IS NULL) AS non_numeric
FROM arrivals
""",
)
def _(d):
    return profile.non_numeric(d.arrivals.select(F.substring("i94port", 2, 10).alias("port_number")), "port_number")


_STATUS = """
CASE WHEN i94visa IS NULL THEN 'NA/Missing' WHEN i94visa IN (1, 2, 3) THEN 'Valid' ELSE 'Invalid' END
"""


@check(
    "a16_visa_class_check",
    f"""
SELECT status, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM arrivals), 6) AS percentage
FROM (SELECT {_STATUS} AS status FROM arrivals) GROUP BY status
""",
)
def _(d):
    return rounded(profile.domain_check(d.arrivals, "i94visa", [1, 2, 3]), "percentage")


@check(
    "a16_visa_class_values",
    f"SELECT {_STATUS} AS status, i94visa AS value, count(*) AS count FROM arrivals GROUP BY 1, 2",
)
def _(d):
    return profile.domain_values(d.arrivals, "i94visa", [1, 2, 3])


def _bins(column: str, table: str, condition: str, bins: int) -> str:
    return f"""
SELECT CAST(b AS INTEGER) AS bin, round(low + b * (high - low) / {bins}, 6) AS "from",
       round(low + (b + 1) * (high - low) / {bins}, 6) AS "to", count(v) AS count
FROM (SELECT CAST(min({column}) AS DOUBLE) AS low, CAST(max({column}) AS DOUBLE) AS high
      FROM {table} WHERE {condition})
CROSS JOIN range({bins}) r(b)
LEFT JOIN (SELECT {column} AS v FROM {table} WHERE {condition})
  ON least(floor((v - low) / ((high - low) / {bins})), {bins} - 1) = b
GROUP BY b, low, high
"""


@check("a17_negative_stay_bins", _bins("stay_days", "stays", "stay_days > -180 AND stay_days < 0", 20))
def _(d):
    stays = profile.stays(d.enriched).where("stay_days < 0")
    return rounded(profile.histogram(stays, "stay_days", 20, lo=-180, open_lo=True), "from", "to")


@check("a17_stay_bins", _bins("stay_days", "stays", "stay_days BETWEEN 0 AND 180", 30))
def _(d):
    return rounded(profile.histogram(profile.stays(d.enriched), "stay_days", 30, lo=0, hi=180), "from", "to")


@check("a17_age_bins", _bins("i94bir", "arrivals", "i94bir BETWEEN 0 AND 100", 20))
def _(d):
    return rounded(profile.histogram(d.arrivals, "i94bir", 20, lo=0, hi=100), "from", "to")


@check(
    "a19_mapping_totals",
    """
SELECT count(*) AS rows, count(*) FILTER (i94cit IS NULL) AS na_values,
       count(*) FILTER (i94cit IS NOT NULL AND NOT citizenship_hit) AS unknown_codes
FROM enriched
""",
)
def _(d):
    return profile.mapping_totals(d.arrivals, "i94cit", d.lookups["i94cntyl"])
