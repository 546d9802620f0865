"""Scans, derived columns and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, texts
from starmart.functions import bands, codes, places, visas
from starmart.operators import dims, fact, profile
from starmart.operators.enrich import with_dates
from starmart.operators.joins import attach
from starmart.sources import arrivals, lookups


@check("s1_scan", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def _(d):
    return arrivals.read(d.spark, f"{d.sf_dir}/orders.parquet", drop_columns=("o_orderdate", "o_orderpriority"))


@check("s1_arrivals", "SELECT * FROM arrivals")
def _(d):
    return d.arrivals


@check(
    "s7_row_sample",
    """
SELECT * EXCLUDE place FROM (
  SELECT *, row_number() OVER (
      PARTITION BY visatype ORDER BY substr(md5(concat(coalesce(visatype, ''), '#', CAST(CAST(cicid AS BIGINT) AS VARCHAR))), 1, 13)) AS place
  FROM arrivals)
WHERE place <= 150
""",
)
def _(d):
    """So many rows of each visa type, as `sample_files` takes them of each file."""
    return arrivals.sample_rows(d.arrivals.withColumn("key", F.col("cicid").cast("bigint")), 150, "key", "visatype").drop("key")


@check(
    "s7_row_sample_by_key",
    """
SELECT * FROM arrivals
WHERE CAST(('0x' || substr(md5(CAST(CAST(cicid AS BIGINT) AS VARCHAR)), 1, 13)) AS BIGINT) < 0.25 * 4503599627370496
""",
)
def _(d):
    keyed = d.arrivals.withColumn("key", F.col("cicid").cast("bigint"))
    return arrivals.sample_by_key(keyed, "key", 0.25).drop("key")


@check(
    "s6_several_files",
    """
SELECT o_orderkey, o_custkey, count(*) AS copies FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders) GROUP BY ALL
""",
)
def _(d):
    path = f"{d.sf_dir}/orders.parquet"
    rows = arrivals.read(d.spark, path, path, drop_columns=["o_comment", "not there"])
    return rows.groupBy("o_orderkey", "o_custkey").agg(F.count("*").alias("copies"))


@check(
    "s9_format_catalog",
    "SELECT 'r' || n_regionkey AS lookup, 'P' || n_nationkey AS code, n_name || ' = ' || r_name AS description "
    "FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def _(d):
    """A catalog per region, as text, with a line per nation; then back from that text."""
    nation, region = (d.spark.read.parquet(f"{d.sf_dir}/{name}.parquet") for name in ("nation", "region"))
    line = F.format_string("  'P%s'\t=  '%s = %s   '", F.col("n_nationkey"), F.col("n_name"), F.col("r_name"))
    lines = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("n_regionkey").agg(
        F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("lines")
    )
    text = F.format_string("/* formats */\nvalue $r%s\n%s\n;\n", F.col("n_regionkey"), F.col("lines"))
    return lookups.parse_catalogs(lines.select(text.alias("value"))).select("lookup", "code", "description")


@check("p14_fact_without_columns", "SELECT CAST(cicid AS BIGINT) AS visitor_id, arrival_date_id, i94port AS port_code FROM clean")
def _(d):
    return fact.arrivals(d.clean.drop("departure_date_id", "visatype", "travel_mode", "is_overstay"))


@check("s8_fields", "SELECT column_name AS field, column_type AS kind FROM (DESCRIBE SELECT * FROM nation)")
def _(d):
    nation = d.spark.read.parquet(f"{d.sf_dir}/nation.parquet")
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR"}
    named = [(name, kinds[kind]) for name, kind in arrivals.fields(nation)]
    return d.spark.createDataFrame(named, "field string, kind string")


@check("t3_first_rows", "SELECT * FROM arrivals ORDER BY cicid LIMIT 5")
def _(d):
    return arrivals.peek(d.arrivals, 5, by=["cicid"])


@check(
    "p1_day_to_date",
    "SELECT cicid, CAST(arrdate_dt AS VARCHAR) AS arrdate_dt, CAST(depdate_dt AS VARCHAR) AS depdate_dt FROM enriched",
)
def _(d):
    return texts(with_dates(d.arrivals).select("cicid", "arrdate_dt", "depdate_dt"), "arrdate_dt", "depdate_dt")


@check("p2_date_id", "SELECT cicid, arrival_date_id, departure_date_id FROM enriched")
def _(d):
    return with_dates(d.arrivals).select("cicid", "arrival_date_id", "departure_date_id")


@check("p3_overstay_flag", "SELECT cicid, is_overstay FROM enriched")
def _(d):
    return d.enriched.select("cicid", "is_overstay")


@check("p4_visa_type_fill", "SELECT cicid, visatype FROM enriched")
def _(d):
    return d.enriched.select("cicid", "visatype")


@check("p5_visa_post_fill", "SELECT visatype, visapost FROM visa_posts")
def _(d):
    return dims.visa_posts(d.clean)


@check("p6_travel_mode", "SELECT cicid, i94mode, travel_mode FROM enriched")
def _(d):
    return d.enriched.select("cicid", "i94mode", "travel_mode")


@check(
    "p7_country_names",
    """
SELECT cicid, COALESCE(c.description, 'Unknown') AS citizenship, COALESCE(r.description, 'Unknown') AS residence
FROM arrivals LEFT JOIN lk_country c ON CAST(CAST(i94cit AS BIGINT) AS VARCHAR) = c.code
              LEFT JOIN lk_country r ON CAST(CAST(i94res AS BIGINT) AS VARCHAR) = r.code
""",
)
def _(d):
    country = d.lookups["i94cntyl"]
    named = dims.with_country(d.arrivals, "i94cit", country, "citizenship")
    return dims.with_country(named, "i94res", country, "residence").select("cicid", "citizenship", "residence")


_WITH_CODE = """
SELECT cicid, CASE WHEN i94cit IS NULL THEN 'Unknown' WHEN description IS NOT NULL THEN description
                   ELSE CONCAT('Unknown(', CAST(i94cit AS VARCHAR), ')') END AS citizenship
FROM arrivals LEFT JOIN lk_country ON CAST(CAST(i94cit AS BIGINT) AS VARCHAR) = code
"""


@check("p8_country_or_code", _WITH_CODE)
def _(d):
    named = dims.with_country(d.arrivals, "i94cit", d.lookups["i94cntyl"], "citizenship", show_code=True)
    return named.select("cicid", "citizenship")


@check(
    "p9_country_profile_name",
    """
SELECT cicid, CASE WHEN i94cit IS NULL THEN 'NA' WHEN description IS NOT NULL THEN description
                   ELSE CONCAT('Unknown (', CAST(CAST(i94cit AS BIGINT) AS VARCHAR), ')') END AS country_name
FROM arrivals LEFT JOIN lk_country ON CAST(CAST(i94cit AS BIGINT) AS VARCHAR) = code
""",
)
def _(d):
    return profile.with_country_name(d.arrivals, "i94cit", d.lookups["i94cntyl"]).select("cicid", "country_name")


@check(
    "p10_visa_purpose",
    """
SELECT cicid, CASE WHEN visatype IS NULL THEN 'Unknown' WHEN visatype = 'B1' THEN 'Business'
                   WHEN visatype = 'B2' THEN 'Tourism/Pleasure' WHEN visatype = 'WT' THEN 'Visa Waiver Tourist'
                   ELSE 'Other' END AS visa_purpose
FROM arrivals
""",
)
def _(d):
    return d.arrivals.select("cicid", visas.visa_purpose(F.col("visatype")).alias("visa_purpose"))


@check(
    "p11_visa_category",
    """
SELECT cicid, CASE i94visa WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure' WHEN 3 THEN 'Student' END AS visa_category
FROM arrivals
""",
)
def _(d):
    return d.arrivals.select("cicid", visas.visa_category(F.col("i94visa")).alias("visa_category"))


@check(
    "p12_purpose_override",
    """
SELECT cicid, CASE WHEN visatype IS NULL THEN 'Unknown' WHEN visatype = 'B1' THEN 'Business'
                   WHEN visatype = 'B2' THEN 'Tourism/Pleasure' WHEN visatype = 'WT' THEN 'Visa Waiver Tourist'
                   WHEN i94visa = 1 THEN 'Business' WHEN i94visa = 2 THEN 'Pleasure' WHEN i94visa = 3 THEN 'Student'
                   ELSE 'Unknown' END AS visa_purpose
FROM arrivals
""",
)
def _(d):
    purpose = visas.visa_purpose(F.col("visatype"))
    category = visas.visa_category(F.col("i94visa"))
    return d.arrivals.select("cicid", visas.refine_purpose(purpose, category).alias("visa_purpose"))


@check(
    "p13_place_parts",
    """
SELECT cicid, trim(split_part(description, ',', 1)) AS city,
       CASE WHEN contains(description, ',') THEN trim(split_part(description, ',', 2)) ELSE 'Unknown' END AS state,
       'US' AS country_code
FROM arrivals JOIN lk_port ON i94port = code
""",
)
def _(d):
    named = attach(d.arrivals, "i94port", d.lookups["i94prtl"], "port").where("port_known")
    return named.select("cicid", F.inline(F.array(places.place_parts(F.col("port")))))


@check(
    "p15_renamed_columns",
    "SELECT CAST(cicid AS BIGINT) AS visitor_id, i94port AS port_code FROM clean",
)
def _(d):
    return fact.arrivals(d.clean.select("cicid", "i94port"))


@check("p18_departed", "SELECT * FROM fact WHERE departure_date_id IS NOT NULL")
def _(d):
    return fact.arrivals(d.clean).where("departure_date_id is not null")


@check("p19_unknown_pattern", f"SELECT * FROM ({_WITH_CODE}) WHERE citizenship LIKE 'Unknown(%)'")
def _(d):
    named = dims.with_country(d.arrivals, "i94cit", d.lookups["i94cntyl"], "citizenship", show_code=True)
    return named.select("cicid", "citizenship").where(F.col("citizenship").rlike(r"Unknown\(.*\)"))


@check("p20_stay_days", "SELECT cicid, stay_days FROM stays")
def _(d):
    return profile.stays(d.enriched).select("cicid", "stay_days")


@check("p21_negative_stays", "SELECT cicid, stay_days FROM stays WHERE stay_days < 0")
def _(d):
    return profile.stays(d.enriched).select("cicid", "stay_days").where("stay_days < 0")


@check("p21_short_negative_stays", "SELECT cicid, stay_days FROM stays WHERE stay_days < 0 AND stay_days > -180")
def _(d):
    return profile.stays(d.enriched).select("cicid", "stay_days").where("stay_days < 0 and stay_days > -180")


@check("p21_usual_stays", "SELECT cicid, stay_days FROM stays WHERE stay_days BETWEEN 0 AND 180")
def _(d):
    return profile.stays(d.enriched).select("cicid", "stay_days").where("stay_days between 0 and 180")


@check(
    "p22_report_age_band",
    """
SELECT cicid, CASE WHEN i94bir < 25 THEN '18-24' WHEN i94bir < 35 THEN '25-34' WHEN i94bir < 45 THEN '35-44'
                   WHEN i94bir < 55 THEN '45-54' ELSE '55+' END AS age_group
FROM arrivals
""",
)
def _(d):
    return d.arrivals.select("cicid", bands.age_band(F.col("i94bir")).alias("age_group"))


PROFILE_BAND = """
CASE WHEN i94bir IS NULL THEN 'NA' WHEN i94bir < 0 THEN 'Negative' WHEN i94bir <= 20 THEN '0-20'
     WHEN i94bir <= 40 THEN '21-40' WHEN i94bir <= 60 THEN '41-60' WHEN i94bir <= 80 THEN '61-80'
     WHEN i94bir <= 100 THEN '81-100' ELSE '100+' END
"""


@check("p23_profile_age_band", f"SELECT cicid, {PROFILE_BAND} AS age_group FROM arrivals")
def _(d):
    return d.arrivals.select("cicid", bands.profile_age_band(F.col("i94bir")).alias("age_group"))


@check("p24_gender_label", "SELECT cicid, COALESCE(gender, 'NA') AS gender FROM arrivals")
def _(d):
    return d.arrivals.select("cicid", F.coalesce("gender", F.lit(profile.NAME_MISSING)).alias("gender"))


@check(
    "p25_coercion",
    """
SELECT cicid, TRY_CAST(substr(i94port, 2) AS DOUBLE) AS number,
       CAST(TRY_CAST(lpad(substr(i94port, 2), 2, '0') || '20-01-31' AS DATE) AS VARCHAR) AS date
FROM arrivals
""",
)
def _(d):
    digits = F.substring("i94port", 2, 10)
    day = codes.to_date(F.concat(F.lpad(digits, 2, "0"), F.lit("20-01-31")))
    return texts(d.arrivals.select("cicid", codes.to_number(digits).alias("number"), day.alias("date")), "date")


@check("p26_wrong_order", "SELECT cicid, arrdate, depdate FROM arrivals WHERE depdate < arrdate")
def _(d):
    return profile.wrong_order(with_dates(d.arrivals)).select("cicid", "arrdate", "depdate")


@check("p27_negative_ages", "SELECT cicid, i94bir FROM arrivals WHERE i94bir < 0")
def _(d):
    return d.arrivals.select("cicid", "i94bir").where("i94bir < 0")


@check("p27_extreme_ages", "SELECT cicid, i94bir FROM arrivals WHERE i94bir > 100")
def _(d):
    return d.arrivals.select("cicid", "i94bir").where("i94bir > 100")


@check("p27_valid_ages", "SELECT cicid, i94bir FROM arrivals WHERE i94bir BETWEEN 0 AND 100")
def _(d):
    return d.arrivals.select("cicid", "i94bir").where("i94bir between 0 and 100")


@check(
    "c1_normal_codes",
    """
SELECT cicid, CAST(CAST(i94cit AS BIGINT) AS VARCHAR) AS citizenship, CAST(CAST(i94mode AS BIGINT) AS VARCHAR) AS mode,
       i94port AS port
FROM arrivals
""",
)
def _(d):
    return d.arrivals.select(
        "cicid",
        codes.code_of(d.arrivals, "i94cit").alias("citizenship"),
        codes.code_of(d.arrivals, "i94mode").alias("mode"),
        codes.code_of(d.arrivals, "i94port").alias("port"),
    )
