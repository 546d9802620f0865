"""Joins, distincts, dimension and fact tables, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, rounded, texts
from starmart import schemas
from starmart.operators import dims, fact
from starmart.operators.joins import attach, sized, unmapped
from starmart.plans import reports


@check(
    "j1_visa_by_category",
    "SELECT visatype, visapost, visa_category FROM visa_posts LEFT JOIN visa_classes USING (visatype)",
)
def _(d):
    return dims.visa_posts(d.clean).join(dims.visa_classes(d.clean), "visatype", "left")


@check("j2_port_membership", "SELECT cicid, i94port, COALESCE(port_hit, FALSE) AS port_known FROM enriched")
def _(d):
    return attach(d.arrivals, "i94port", d.lookups["i94prtl"], "port").select("cicid", "i94port", "port_known")


@check(
    "j3_lookup_texts",
    """
SELECT cicid, p.description AS port, c.description AS citizenship, r.description AS residence, m.description AS mode
FROM arrivals LEFT JOIN lk_port p ON i94port = p.code
LEFT JOIN lk_country c ON CAST(CAST(i94cit AS BIGINT) AS VARCHAR) = c.code
LEFT JOIN lk_country r ON CAST(CAST(i94res AS BIGINT) AS VARCHAR) = r.code
LEFT JOIN lk_mode m ON CAST(CAST(i94mode AS BIGINT) AS VARCHAR) = m.code
""",
)
def _(d):
    df = attach(d.arrivals, "i94port", d.lookups["i94prtl"], "port")
    df = attach(df, "i94cit", d.lookups["i94cntyl"], "citizenship")
    df = attach(df, "i94res", d.lookups["i94cntyl"], "residence")
    return attach(df, "i94mode", d.lookups["i94model"], "mode").select("cicid", "port", "citizenship", "residence", "mode")


@check("j4_ports_in_lookup", "SELECT port_code FROM dim_port")
def _(d):
    return dims.port(d.clean, d.lookups).select("port_code")


@check(
    "j5_fact_visitor_visa",
    """
SELECT CAST(cicid AS BIGINT) AS visitor_id,
       (SELECT any_value(country_of_citizenship) FROM dim_visitor holder WHERE holder.visitor_id = CAST(cicid AS BIGINT))
           AS country_of_citizenship,
       (SELECT any_value(visa_purpose) FROM dim_visa_by_code label WHERE label.visa_code = visatype) AS visa_purpose
FROM clean
""",
)
def _(d):
    visa = d.star[schemas.DIM_VISA].withColumnRenamed("visa_code", "visatype")
    joined = d.star[schemas.FACT].join(d.star[schemas.DIM_VISITOR], "visitor_id").join(visa, "visatype")
    return joined.select("visitor_id", "country_of_citizenship", "visa_purpose")


_PLACES_AND_DAYS = """
SELECT CAST(cicid AS BIGINT) AS visitor_id, spot.city, spot.state, CAST(arrdate_dt AS VARCHAR) AS arrived,
       CAST(depdate_dt AS VARCHAR) AS departed
FROM clean JOIN dim_port spot ON spot.port_code = i94port
WHERE arrdate_dt IS NOT NULL AND depdate_dt IS NOT NULL
"""


def _places_and_days(d):
    days = d.star[schemas.DIM_DATE]
    arrival = days.select(F.col("date_id").alias("arrival_date_id"), F.col("full_date").alias("arrived"))
    departure = days.select(F.col("date_id").alias("departure_date_id"), F.col("full_date").alias("departed"))
    joined = (
        d.star[schemas.FACT]
        .join(sized(d.star[schemas.DIM_PORT], d.lookups[schemas.PORT]), "port_code")
        .join(sized(arrival), "arrival_date_id")
        .join(sized(departure), "departure_date_id")
    )
    return texts(joined.select("visitor_id", "city", "state", "arrived", "departed"), "arrived", "departed")


check("j6_fact_port_dates", _PLACES_AND_DAYS)(_places_and_days)
check("j6_fact_port_dates_late", _PLACES_AND_DAYS, late=True)(_places_and_days)


@check(
    "j7_fact_visitor",
    """
SELECT holder.visitor_id, holder.country_of_citizenship, holder.age, depdate IS NULL AS is_overstay
FROM clean LEFT JOIN dim_visitor holder ON holder.visitor_id = CAST(clean.cicid AS BIGINT)
""",
    visitor="ck",
)
def _(d):
    joined = d.star[schemas.FACT].join(d.star[schemas.DIM_VISITOR], "visitor_id")
    return joined.select("visitor_id", "country_of_citizenship", "age", "is_overstay")


@check(
    "j8_invalid_ports",
    "SELECT cicid, i94port FROM arrivals WHERE i94port IS NOT NULL AND i94port NOT IN (SELECT code FROM lk_port)",
)
def _(d):
    return unmapped(d.arrivals, "i94port", d.lookups["i94prtl"]).select("cicid", "i94port")


@check(
    "j9_unmapped_countries",
    """
SELECT cicid, i94cit FROM arrivals
WHERE i94cit IS NOT NULL AND CAST(CAST(i94cit AS BIGINT) AS VARCHAR) NOT IN (SELECT code FROM lk_country)
""",
)
def _(d):
    return unmapped(d.arrivals, "i94cit", d.lookups["i94cntyl"]).select("cicid", "i94cit")


@check("e1_visa_type_posts", "SELECT DISTINCT visatype, visapost FROM clean")
def _(d):
    return d.clean.select("visatype", "visapost").distinct()


@check("e1_visa_types", "SELECT DISTINCT visatype FROM clean")
def _(d):
    return d.clean.select("visatype").distinct()


@check("e1_visa_type_classes", "SELECT DISTINCT visatype, i94visa FROM clean")
def _(d):
    return d.clean.select("visatype", "i94visa").distinct()


@check("e1_ports", "SELECT DISTINCT i94port FROM clean")
def _(d):
    return d.clean.select("i94port").distinct()


@check("e2_one_row_per_visitor", "SELECT * FROM dim_visitor", visitor="ck")
def _(d):
    return dims.visitor(d.clean, d.lookups)


@check(
    "e3_unknown_member",
    """
SELECT visa_code, visa_issuing_post, visa_purpose, visa_category FROM visa_named WHERE visa_code <> 'Unknown'
UNION ALL SELECT 'Unknown', 'Unknown', 'Unknown', NULL
""",
)
def _(d):
    known = d.clean.where("visatype <> 'Unknown'")
    return dims.with_unknown_member(dims.visa(d.clean).where("visa_code <> 'Unknown'"), known)


@check(
    "t2_arrivals_by_day",
    "SELECT arrival_date_id, count(*) AS count FROM fact GROUP BY arrival_date_id ORDER BY arrival_date_id",
)
def _(d):
    return d.star[schemas.FACT].groupBy("arrival_date_id").count().orderBy("arrival_date_id")


_DATE_COLUMNS = """
date_id, CAST(full_date AS VARCHAR) AS full_date, year, month, month_name, day, day_of_week, weekday_name, is_weekend,
quarter
"""


@check(
    "b1_date_dim",
    f"""
SELECT {_DATE_COLUMNS}, COALESCE(arrivals, 0) AS arrivals
FROM dim_date LEFT JOIN (SELECT arrival_date_id, count(*) AS arrivals FROM fact GROUP BY 1) ON date_id = arrival_date_id
""",
)
def _(d):
    """The date table with the arrivals of each day."""
    per_day = d.star[schemas.FACT].groupBy(F.col("arrival_date_id").alias("date_id")).agg(
        F.count(F.lit(1)).alias("arrivals")
    )
    days = d.star[schemas.DIM_DATE].join(per_day, "date_id", "left")
    return texts(days.withColumn("arrivals", F.coalesce("arrivals", F.lit(0))), "full_date")


@check("b2_visitor_dim", "SELECT * FROM dim_visitor")
def _(d):
    return dims.visitor(d.clean, d.lookups)


@check("b3_visa_dim", "SELECT * FROM dim_visa")
def _(d):
    return dims.visa(d.clean)


@check("b3k_visa_by_code", "SELECT * FROM dim_visa_by_code")
def _(d):
    return dims.visa_by_code(d.clean)


@check("b4_port_dim", "SELECT * FROM dim_port")
def _(d):
    return dims.port(d.clean, d.lookups)


@check("b5_fact", "SELECT * FROM fact")
def _(d):
    return fact.arrivals(d.clean)


def _visa_report(table: str) -> str:
    return f"""
SELECT holder.country_of_citizenship, label.visa_purpose, CAST(sum(trips.n) AS BIGINT) AS visitor_count
FROM (SELECT CAST(cicid AS BIGINT) AS holder_id, visatype AS kind, count(*) AS n FROM clean GROUP BY ALL) trips
LEFT JOIN dim_visitor holder ON holder.visitor_id = trips.holder_id
LEFT JOIN {table} label ON label.visa_code = trips.kind
GROUP BY ALL
"""


@check("a3_visa_by_country", _visa_report("dim_visa_by_code"))
def _(d):
    return reports.visa_by_country(d.star)


@check("a3_visa_by_country_full_grain", _visa_report("dim_visa"))
def _(d):
    """The visa table at its full grain: an arrival counts once for each row of its visa type."""
    return reports.visa_by_country({**d.star, schemas.DIM_VISA: dims.visa(d.clean)}, per_code=False)


@check("a3_visa_by_country_reduced", _visa_report("dim_visa_by_code"))
def _(d):
    """The report over the table of full grain: an arrival counts once all the same."""
    return reports.visa_by_country({**d.star, schemas.DIM_VISA: dims.visa(d.clean)})


@check("a3_visa_by_country_frequent", _visa_report("dim_visa_by_code"), visitor="ck")
def _(d):
    return reports.visa_by_country(d.star)


_STAYS_BY_PLACE = """
SELECT spot.city, spot.state, round(avg(gone.days), 6) AS avg_stay_days, count(*) AS visitor_count
FROM (SELECT i94port AS gate, datediff('day', arrdate_dt, depdate_dt) AS days FROM clean WHERE depdate IS NOT NULL) gone
JOIN dim_port spot ON spot.port_code = gone.gate GROUP BY ALL
"""


def _stay_by_port(d):
    return rounded(reports.stay_by_port(d.star, port_bound=d.lookups[schemas.PORT]), "avg_stay_days")


check("a4_stay_by_port", _STAYS_BY_PLACE)(_stay_by_port)
check("a4_stay_by_port_late", _STAYS_BY_PLACE, late=True)(_stay_by_port)


_OVERSTAY_REPORT = """
SELECT holder.country_of_citizenship,
       ['18-24', '25-34', '35-44', '45-54', '55+'][CAST(1 + least(4, greatest(0, (coalesce(holder.age, 99) - 15) // 10))
           AS INTEGER)] AS age_group,
       trips.gone IS NULL AS is_overstay, CAST(sum(trips.n) AS BIGINT) AS visitor_count
FROM (SELECT CAST(cicid AS BIGINT) AS holder_id, CASE WHEN depdate IS NOT NULL THEN 1 END AS gone, count(*) AS n
      FROM clean GROUP BY ALL) trips
LEFT JOIN dim_visitor holder ON holder.visitor_id = trips.holder_id GROUP BY ALL
"""


@check("a5_overstay_by_age", _OVERSTAY_REPORT)
def _(d):
    return reports.overstay_by_age(d.star)


@check("a5_overstay_by_age_frequent", _OVERSTAY_REPORT, visitor="ck")
def _(d):
    return reports.overstay_by_age(d.star)
