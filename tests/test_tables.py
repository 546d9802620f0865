from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from starmart import schemas
from starmart.operators import dims, fact, joins, rules
from starmart.plans import etl, reports


@pytest.fixture
def clean(arrivals, named):
    def build(*changes, without=()):
        return rules.split(*etl.check(arrivals(*changes, without=without), named))[0]

    return build


def test_date_table(spark):
    days = dims.date(spark)
    assert days.count() == 25569
    first = days.where("date_id = 20160430").collect()[0]
    assert first.asDict() == {
        "date_id": 20160430, "full_date": date(2016, 4, 30), "year": 2016, "month": 4, "month_name": "April",
        "day": 30, "day_of_week": 7, "weekday_name": "Saturday", "is_weekend": True, "quarter": 2,
    }
    assert days.where("not is_weekend and day_of_week in (1, 7)").isEmpty()
    assert dims.date(spark, "2020-02-28", "2020-03-01").count() == 3


def test_visitor_table_has_one_row_per_id_and_the_same_one_each_time(clean, named):
    rows = clean({"gender": "M"}, {"gender": "F"}, {"i94cit": 102.0}, {"cicid": 2.0, "i94cit": None, "gender": None})
    got = {r.visitor_id: r for r in dims.visitor(rows, named).collect()}
    assert got.keys() == {1, 2}
    assert (got[1].country_of_citizenship, got[1].gender, got[1].age) == ("AVALON", "F", 30)
    assert (got[2].country_of_citizenship, got[2].country_of_citizenship_code) == ("Unknown", None)
    assert got[2].country_of_residence == "BRASIL" and got[2].country_of_residence_code == "102"
    assert [f.name for f in dims.visitor(rows, named).schema] == list(schemas.VISITOR_COLUMNS)


def test_visitor_rows_are_thinned_before_the_shuffle(spark, named):
    people = spark.range(1000).select(
        (F.col("id") % 1 + 7).alias("cicid"), (F.col("id") % 50).cast("double").alias("i94bir"), F.lit("F").alias("gender")
    )
    plan = dims.visitor(people, named)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_min")
    assert [(r.visitor_id, r.age) for r in dims.visitor(people, named).collect()] == [(7, 0)]


def test_visitor_ids_beyond_int(clean, named):
    assert dims.visitor(clean({"cicid": 5e9}), named).collect()[0].visitor_id == 5_000_000_000
    assert fact.arrivals(clean({"cicid": 5e9})).collect()[0].visitor_id == 5_000_000_000


def test_visa_table_keeps_its_grain(clean):
    rows = clean({"visapost": None}, {"visapost": "Unknown"}, {"visatype": "X9", "i94visa": 2.0}, {"visatype": "X9", "i94visa": 4.0})
    got = sorted(tuple(r) for r in dims.visa(rows).fillna("-").collect())
    assert got == [
        ("B1", "Unknown", "Business", "Business"),
        ("B1", "Unknown", "Business", "Business"),
        ("Unknown", "Unknown", "Unknown", "-"),
        ("X9", "POST", "Pleasure", "Pleasure"),
        ("X9", "POST", "Unknown", "-"),
    ]
    by_code = {r.visa_code: tuple(r)[1:] for r in dims.visa_by_code(rows).collect()}
    assert by_code == {
        "B1": ("Unknown", "Business", "Business"),
        "X9": ("POST", "Pleasure", "Pleasure"),
        "Unknown": ("Unknown", "Unknown", None),
    }


def test_unknown_visa_row_is_there_once(clean):
    with_null = dims.visa(clean({"visatype": None, "i94visa": 1.0}, {}))
    assert with_null.where("visa_code = 'Unknown'").count() == 1
    assert dims.visa(clean({})).where("visa_code = 'Unknown'").count() == 1


def test_visa_table_without_optional_columns(clean):
    assert [tuple(r) for r in dims.visa(clean({"visatype": "Unknown"}, without=("visapost", "i94visa"))).collect()] == [
        ("Unknown", "Unknown", "Unknown", None)
    ]


def test_port_table(clean, named):
    got = sorted(tuple(r) for r in dims.port(clean({}, {"i94port": "P3"}, {"i94port": None}, {"i94port": "P3"}), named).collect())
    assert got == [("P1", "HARBOR, AA", "HARBOR", "AA", "US"), ("P3", "PASS, OLD ROAD, BB", "PASS", "OLD ROAD", "US")]


def test_fact_table(clean):
    rows = fact.arrivals(clean({}, {"depdate": None, "i94mode": 7.0}))
    assert [f.name for f in rows.schema] == list(schemas.FACT_COLUMNS)
    got = sorted(tuple(r) for r in rows.fillna(0).collect())
    assert got == [
        (1, 20160429, 0, "P1", "B1", "Unknown", True),
        (1, 20160429, 20160506, "P1", "B1", "Air", False),
    ]


def test_fact_table_moves_no_rows(spark):
    rows = spark.range(5).select(F.col("id").cast("double").alias("cicid"), F.lit("P1").alias("i94port"))
    assert "Exchange" not in fact.arrivals(rows)._jdf.queryExecution().executedPlan().toString()


def test_fact_table_needs_some_column(spark):
    with pytest.raises(ValueError):
        fact.arrivals(spark.range(1))


@pytest.fixture
def star(spark):
    def build(arrivals_rows, visitors):
        return {
            schemas.FACT: spark.createDataFrame(arrivals_rows, "visitor_id long, arrival_date_id int, departure_date_id int, port_code string, visatype string, travel_mode string, is_overstay boolean"),
            schemas.DIM_VISITOR: spark.createDataFrame(visitors, "visitor_id long, country_of_citizenship string, age int"),
            schemas.DIM_VISA: spark.createDataFrame([("B1", "Business"), ("B1", "Business"), ("F1", "Student")], "visa_code string, visa_purpose string"),
            schemas.DIM_PORT: spark.createDataFrame([("P1", "HARBOR", "AA"), ("P4", "HARBOR", "AA")], "port_code string, city string, state string"),
            schemas.DIM_DATE: dims.date(spark),
        }

    return build


def test_reports(star):
    tables = star(
        [
            (1, 20160101, 20160103, "P1", "B1", "Air", False),
            (1, 20160101, 20160105, "P4", "F1", "Air", False),
            (1, 20160101, None, "P1", "F1", "Air", True),
            (2, 20160101, 20350101, "P1", "XX", "Air", False),
            (9, 20160101, 20160102, "P9", "B1", "Air", False),
        ],
        [(1, "AVALON", 24), (2, "BRASIL", None)],
    )
    by_visa = {(r.country_of_citizenship, r.visa_purpose): r.visitor_count for r in reports.visa_by_country(tables).collect()}
    assert by_visa == {("AVALON", "Business"): 1, ("AVALON", "Student"): 2}
    by_row = {(r.country_of_citizenship, r.visa_purpose): r.visitor_count for r in reports.visa_by_country(tables, per_code=False).collect()}
    assert by_row == {("AVALON", "Business"): 2, ("AVALON", "Student"): 2}
    assert [tuple(r) for r in reports.stay_by_port(tables).collect()] == [("HARBOR", "AA", 3.0, 2)]
    overstays = {tuple(r) for r in reports.overstay_by_age(tables).collect()}
    assert overstays == {("AVALON", "18-24", False, 2), ("AVALON", "18-24", True, 1), ("BRASIL", "55+", False, 1)}


def test_one_visitor_with_a_third_of_all_arrivals_is_counted_before_the_join(spark, star):
    tables = star([(1, 20160101, None, "P1", "B1", "Air", True)], [(0, "AVALON", 30), (1, "BRASIL", 40), (2, "BRASIL", 60)])
    rows = spark.range(3000)
    tables[schemas.FACT] = rows.select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2 + 1).alias("visitor_id"),
        F.lit("F1").alias("visatype"),
        F.lit(True).alias("is_overstay"),
    )
    got = {(r.country_of_citizenship, r.age_group): r.visitor_count for r in reports.overstay_by_age(tables).collect()}
    assert got == {("AVALON", "25-34"): 1000, ("BRASIL", "35-44"): 1000, ("BRASIL", "55+"): 1000}
    plan = reports.overstay_by_age(tables)._jdf.queryExecution().executedPlan().toString()
    before_join = plan[plan.index("Join [visitor_id"):]
    assert before_join.index("Exchange hashpartitioning(visitor_id") < before_join.index("partial_count")


def test_visa_report_shuffles_facts_once(spark, star):
    """By visitor, with nothing below the join that keeps adaptive execution from splitting a hot visitor."""
    tables = star([(1, 20160101, None, "P1", "B1", "Air", True)], [(0, "AVALON", 30), (1, "BRASIL", 40), (2, "BRASIL", 60)])
    tables[schemas.FACT] = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2 + 1).alias("visitor_id"), F.lit("F1").alias("visatype")
    )
    report = reports.visa_by_country(tables)
    assert {tuple(r) for r in report.collect()} == {("AVALON", "Student", 1000), ("BRASIL", "Student", 2000)}
    plan = reports.visa_by_country(tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(visitor_id") == 2
    assert "partial_count" not in plan[plan.index("Exchange hashpartitioning(visitor_id"):]


def test_unknown_visa_type_needs_no_nested_loop(spark):
    rows = spark.createDataFrame([("B1", "P", 1.0), ("B1", "O", 2.0)], "visatype string, visapost string, i94visa double")
    for table in (dims.visa(rows), dims.visa_by_code(rows)):
        assert table.where("visa_code = 'Unknown'").count() == 1
        assert "NestedLoop" not in table._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in dims.visa_by_code(rows)._jdf.queryExecution().executedPlan().toString()
    known = rows.union(spark.createDataFrame([("Unknown", None, None)], rows.schema))
    for table in (dims.visa(known), dims.visa_by_code(known)):
        assert table.where("visa_code = 'Unknown'").count() == 1


def test_broadcast_depends_on_the_size(spark, named, monkeypatch, tmp_path):
    path = str(tmp_path / "lookup")
    named["i94prtl"].coalesce(1).write.parquet(path)
    lookup = spark.read.parquet(path)
    rows = spark.range(10).select(F.concat(F.lit("P"), F.col("id") % 1 + 1).alias("i94port"))
    hinted = joins.attach(rows, "i94port", lookup, "port")
    assert "ResolvedHint" in hinted._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1)
    plain = joins.attach(rows, "i94port", lookup, "port")
    assert "ResolvedHint" not in plain._jdf.queryExecution().analyzed().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plain._jdf.queryExecution().executedPlan().toString()
        assert plain.where("port_known").count() == 10 == hinted.where("port_known").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_visitors_are_never_broadcast(star):
    tables = star([(1, 20160101, None, "P1", "B1", "Air", True)], [(1, "BRASIL", 40)])
    for report in (reports.overstay_by_age, reports.visa_by_country):
        assert "SortMergeJoin [visitor_id" in report(tables)._jdf.queryExecution().executedPlan().toString()


def test_visitor_table_of_ids_alone(spark, named):
    ids = spark.createDataFrame([(1.0,), (1.0,), (2.0,)], "cicid double")
    assert sorted(r.visitor_id for r in dims.visitor(ids, named).collect()) == [1, 2]
    with pytest.raises(ValueError):
        dims.visitor(ids.withColumnRenamed("cicid", "other"), named)
