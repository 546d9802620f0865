"""Rules, split, quarantine, counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, rounded, texts
from starmart.operators import rules
from starmart.plans import etl

_RULE_COLUMNS = "cicid, i94port, departure_date_id, i94bir, i94cit, i94res"
_BLANKED = """
cicid, CASE WHEN NOT rule_port THEN i94port END AS i94port,
CASE WHEN NOT rule_dates THEN departure_date_id END AS departure_date_id,
CASE WHEN NOT rule_age THEN i94bir END AS i94bir, i94cit, i94res
"""


def _rule_check(key: str, rule: str) -> None:
    @check(f"{key}_{rule}_rule", f"SELECT {_BLANKED} FROM judged WHERE rule_{rule}")
    def _(d):
        return d.checked.where(f"rule_{rule}").select(*_RULE_COLUMNS.split(", "))


_rule_check("v1", "port")
_rule_check("v2", "dates")
_rule_check("v3", "age")
_rule_check("v4", "citizenship")
_rule_check("v5", "residence")


@check("v6_is_rejected", "SELECT cicid, is_rejected FROM judged")
def _(d):
    return d.flagged.select("cicid", "is_rejected")


@check("v7_rejection_reason", "SELECT cicid, rejection_reason FROM judged")
def _(d):
    return d.flagged.select("cicid", "rejection_reason")


@check("p17_clean_filter", "SELECT cicid, i94port, visatype FROM judged WHERE NOT is_rejected")
def _(d):
    return d.clean.select("cicid", "i94port", "visatype")


@check("p17_rejected_filter", "SELECT cicid, visatype, rejection_reason FROM judged WHERE is_rejected")
def _(d):
    return d.rejected.select("cicid", "visatype", "rejection_reason")


_CLEAN_COLUMNS = """
cicid, i94cit, i94res, i94port, arrdate, depdate, i94mode, i94bir, biryear, gender, visatype, visapost, i94visa,
CAST(arrdate_dt AS VARCHAR) AS arrdate_dt, CAST(depdate_dt AS VARCHAR) AS depdate_dt, arrival_date_id,
departure_date_id, travel_mode, is_overstay
"""


@check("v8_clean_rows", f"SELECT {_CLEAN_COLUMNS} FROM clean")
def _(d):
    return texts(d.clean, "arrdate_dt", "depdate_dt")


@check("v8_rejected_rows", f"SELECT {_BLANKED}, rejection_reason FROM rejected")
def _(d):
    return d.rejected.select(*_RULE_COLUMNS.split(", "), "rejection_reason")


@check(
    "v9_rule_counts",
    """
SELECT 'port' AS rule, count(*) FILTER (rule_port) AS rows FROM judged
UNION ALL SELECT 'dates', count(*) FILTER (rule_dates) FROM judged
UNION ALL SELECT 'age', count(*) FILTER (rule_age) FROM judged
UNION ALL SELECT 'citizenship', count(*) FILTER (rule_citizenship) FROM judged
UNION ALL SELECT 'residence', count(*) FILTER (rule_residence) FROM judged
""",
)
def _(d):
    return rules.rule_counts(d.flagged, d.rules)


@check(
    "v10_quality_metrics",
    """
SELECT 'total' AS metric, NULL AS item, count(*) AS rows FROM judged
UNION ALL SELECT 'rejected', NULL, count(*) FROM rejected
UNION ALL SELECT 'reason', rejection_reason, count(*) FROM rejected GROUP BY rejection_reason
UNION ALL SELECT 'rule', 'port', count(*) FILTER (rule_port) FROM judged
UNION ALL SELECT 'rule', 'dates', count(*) FILTER (rule_dates) FROM judged
UNION ALL SELECT 'rule', 'age', count(*) FILTER (rule_age) FROM judged
UNION ALL SELECT 'rule', 'citizenship', count(*) FILTER (rule_citizenship) FROM judged
UNION ALL SELECT 'rule', 'residence', count(*) FILTER (rule_residence) FROM judged
UNION ALL SELECT 'missing', 'visa_type', count(*) FILTER (visatype IS NULL) FROM arrivals
UNION ALL SELECT 'missing', 'departure', count(*) FILTER (depdate IS NULL) FROM arrivals
""",
)
def _(d):
    return rules.metrics(d.flagged, d.rules)


@check(
    "v9_missing_counts",
    """
SELECT 'visa_type' AS missing, count(*) - count(visatype) AS rows FROM arrivals
UNION ALL SELECT 'departure', count(*) - count(depdate) FROM arrivals
""",
)
def _(d):
    return rules.missing_counts(d.flagged)


@check(
    "v11_quarantine",
    """
SELECT a.cicid AS original_cicid, a.i94port AS original_port, a.depdate AS original_depdate, a.i94bir AS original_age,
       a.visatype AS original_visatype, a.i94cit AS original_citizenship, is_rejected, rejection_reason
FROM rejected r JOIN arrivals a ON r.cicid = a.cicid
""",
)
def _(d):
    kept = rules.quarantine(rules.split(*etl.check(d.arrivals, d.lookups))[1])
    return kept.select(
        F.col("original_record.cicid").alias("original_cicid"),
        F.col("original_record.i94port").alias("original_port"),
        F.col("original_record.depdate").alias("original_depdate"),
        F.col("original_record.i94bir").alias("original_age"),
        F.col("original_record.visatype").alias("original_visatype"),
        F.col("original_record.i94cit").alias("original_citizenship"),
        "is_rejected",
        "rejection_reason",
    )


@check(
    "a1_rejection_summary",
    'SELECT rejection_reason AS "Rejection Reason", count(*) AS "Count" FROM rejected GROUP BY rejection_reason',
)
def _(d):
    return rules.summary(d.rejected)


@check(
    "x1_rejection_rate_by_day",
    """
SELECT CAST(arrdate_dt AS VARCHAR) AS arrdate_dt, rejection_reason, count(*) AS rows,
       round(count(*) * 100.0 / max(total), 6) AS percent
FROM judged JOIN (SELECT arrdate_dt, count(*) AS total FROM judged GROUP BY arrdate_dt) USING (arrdate_dt)
WHERE rejection_reason IS NOT NULL GROUP BY arrdate_dt, rejection_reason
""",
)
def _(d):
    return rounded(texts(rules.rate_by_day(d.flagged), "arrdate_dt").drop("total"), "percent")
