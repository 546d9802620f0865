"""The tables of the job as plain SQL, written apart from the Spark code."""

from __future__ import annotations

from checks.fixtures import LK_COUNTRY, LK_MODE, LK_PORT, arrivals_sql

# {day} and {visitor} are left open for the caller.
PREFIX = f"""
WITH lk_port AS ({LK_PORT}),
lk_country AS ({LK_COUNTRY}),
lk_mode AS ({LK_MODE}),
arrivals AS ({arrivals_sql("{day}", visitor="{visitor}")}),
enriched AS (
  SELECT a.* REPLACE (COALESCE(visatype, 'Unknown') AS visatype),
         DATE '1960-01-01' + CAST(arrdate AS INTEGER) AS arrdate_dt,
         DATE '1960-01-01' + CAST(depdate AS INTEGER) AS depdate_dt,
         CAST(strftime(DATE '1960-01-01' + CAST(arrdate AS INTEGER), '%Y%m%d') AS INTEGER) AS arrival_date_id,
         CAST(strftime(DATE '1960-01-01' + CAST(depdate AS INTEGER), '%Y%m%d') AS INTEGER) AS departure_date_id,
         COALESCE(m.description, 'Unknown') AS travel_mode,
         depdate IS NULL AS is_overstay,
         i94port IN (SELECT code FROM lk_port) AS port_hit,
         CAST(CAST(i94cit AS BIGINT) AS VARCHAR) IN (SELECT code FROM lk_country) AS citizenship_hit,
         CAST(CAST(i94res AS BIGINT) AS VARCHAR) IN (SELECT code FROM lk_country) AS residence_hit
  FROM arrivals a LEFT JOIN lk_mode m ON CAST(CAST(a.i94mode AS BIGINT) AS VARCHAR) = m.code
),
flagged AS (
  SELECT *, COALESCE(NOT port_hit, FALSE) AS rule_port,
         COALESCE(depdate_dt < arrdate_dt, FALSE) AS rule_dates,
         COALESCE(i94bir < 0, FALSE) AS rule_age,
         COALESCE(NOT citizenship_hit, FALSE) AS rule_citizenship,
         COALESCE(NOT residence_hit, FALSE) AS rule_residence
  FROM enriched
),
judged AS (
  SELECT *, rule_port OR rule_dates OR rule_age OR rule_citizenship OR rule_residence AS is_rejected,
         CASE WHEN rule_residence THEN 'Unknown country residence code'
              WHEN rule_citizenship THEN 'Unknown country citizenship code'
              WHEN rule_age THEN 'Negative age value'
              WHEN rule_dates THEN 'Departure date before arrival date'
              WHEN rule_port THEN 'Invalid port code' END AS rejection_reason
  FROM flagged
),
clean AS (SELECT * FROM judged WHERE NOT is_rejected),
rejected AS (SELECT * FROM judged WHERE is_rejected),
fact AS (
  SELECT CAST(cicid AS BIGINT) AS visitor_id, arrival_date_id, departure_date_id, i94port AS port_code, visatype,
         travel_mode, is_overstay
  FROM clean
),
people AS (
  SELECT CAST(cicid AS BIGINT) AS visitor_id, i94cit, i94res,
         CAST(CAST(i94cit AS BIGINT) AS VARCHAR) AS country_of_citizenship_code,
         CAST(CAST(i94res AS BIGINT) AS VARCHAR) AS country_of_residence_code,
         CAST(i94bir AS INTEGER) AS age, gender, CAST(biryear AS INTEGER) AS biryear
  FROM clean
),
one_each AS (
  SELECT *, row_number() OVER (
      PARTITION BY visitor_id
      ORDER BY i94cit NULLS FIRST, i94res NULLS FIRST, age NULLS FIRST, biryear NULLS FIRST, gender NULLS FIRST) AS place
  FROM people
),
dim_visitor AS (
  SELECT visitor_id, COALESCE(c.description, 'Unknown') AS country_of_citizenship, country_of_citizenship_code,
         COALESCE(r.description, 'Unknown') AS country_of_residence, country_of_residence_code, age, gender, biryear
  FROM one_each LEFT JOIN lk_country c ON country_of_citizenship_code = c.code
                LEFT JOIN lk_country r ON country_of_residence_code = r.code
  WHERE place = 1
),
visa_posts AS (
  SELECT visatype, COALESCE(visapost, 'Unknown') AS visapost FROM (SELECT DISTINCT visatype, visapost FROM clean)
),
visa_classes AS (
  SELECT visatype, CASE i94visa WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure' WHEN 3 THEN 'Student' END
         AS visa_category
  FROM (SELECT DISTINCT visatype, i94visa FROM clean)
),
visa_named AS (
  SELECT visatype AS visa_code, visapost AS visa_issuing_post,
         CASE visatype WHEN 'B1' THEN 'Business' WHEN 'B2' THEN 'Tourism/Pleasure'
              WHEN 'WT' THEN 'Visa Waiver Tourist' WHEN 'Unknown' THEN 'Unknown'
              ELSE COALESCE(visa_category, 'Unknown') END AS visa_purpose,
         visa_category
  FROM visa_posts LEFT JOIN visa_classes USING (visatype)
),
dim_visa AS (
  SELECT * FROM visa_named
  UNION ALL SELECT 'Unknown', 'Unknown', 'Unknown', NULL
  WHERE NOT EXISTS (SELECT 1 FROM visa_named WHERE visa_code = 'Unknown')
),
visa_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY visa_code ORDER BY visa_category NULLS LAST, visa_purpose) AS place,
         min(visa_issuing_post) OVER (PARTITION BY visa_code) AS first_post
  FROM dim_visa
),
dim_visa_by_code AS (
  SELECT visa_code, first_post AS visa_issuing_post, visa_purpose, visa_category FROM visa_ranked WHERE place = 1
),
dim_port AS (
  SELECT code AS port_code, description AS port_of_entry, trim(split_part(description, ',', 1)) AS city,
         CASE WHEN contains(description, ',') THEN trim(split_part(description, ',', 2)) ELSE 'Unknown' END AS state,
         'US' AS country_code
  FROM lk_port WHERE code IN (SELECT i94port FROM clean)
),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS DATE) AS full_date,
         CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
         CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
         dayname(d) AS weekday_name, dayofweek(d) IN (0, 6) AS is_weekend, CAST(quarter(d) AS INTEGER) AS quarter
  FROM generate_series(DATE '1960-01-01', DATE '2030-01-01', INTERVAL 1 DAY) s(d)
),
stays AS (
  SELECT *, CAST(datediff('day', arrdate_dt, depdate_dt) AS INTEGER) AS stay_days
  FROM enriched WHERE arrdate_dt IS NOT NULL AND depdate_dt IS NOT NULL
)
"""
