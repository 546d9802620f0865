from __future__ import annotations

import os

import pytest

from starmart import __main__ as cli
from starmart import schemas, session
from starmart.plans import etl, reports
from tests.test_rules import BAD

LOOKUPS = {
    "i94prtl": 'code,description\nP1,"HARBOR, AA"\nP2,INLAND\n',
    "i94cntyl": "code,description\n101,AVALON\n102,BRASIL\n",
    "i94model": "code,description\n1,Air\n2,Sea\n3,Land\n9,Not reported\n",
}


@pytest.fixture
def paths(tmp_path, arrivals):
    def build(*changes, without=(), lookups=LOOKUPS):
        staging = tmp_path / "staging"
        staging.mkdir()
        for name, text in lookups.items():
            (staging / f"{name}.csv").write_text(text)
        arrivals(*changes, without=without).write.parquet(str(tmp_path / "in"))
        return [str(tmp_path / name) for name in ("in", "staging", "out", "rejected")]

    return build


def test_whole_job(spark, paths):
    visitors = [{"cicid": float(i), "depdate": None if i % 2 else 20580.0} for i in range(1, 5)]
    bad = [{"cicid": 100.0 + i, **change} for i, change in enumerate(BAD.values())]
    where = paths(*visitors, *bad)
    shared = session.shared_folder(spark, "nowhere")
    assert shared == spark.conf.get("spark.checkpoint.dir")
    result = etl.run(spark, *where)
    assert result.rows == {
        "dim_date": 25569,
        "dim_visitor": 4,
        "dim_visa": 2,
        "dim_port": 1,
        "fact_immigration": 4,
        "quality_metrics": 14,
        "rejected_immigration_records": 5,
        "rejection_summary": 5,
    }
    assert result.skipped_rules == [] and result.skipped_tables == []
    assert not [name for name in os.listdir(shared) if name.startswith("_checked")]

    out, rejected = where[2], where[3]
    tables = reports.load(spark, out)
    assert tables[schemas.FACT].columns == list(schemas.FACT_COLUMNS)
    # The visa table holds one row per post and class, so this type counts once.
    assert [tuple(r) for r in reports.visa_by_country(tables).collect()] == [("AVALON", "Business", 4)]
    assert [tuple(r) for r in reports.stay_by_port(tables).collect()] == [("HARBOR", "AA", 7.0, 2)]
    sql = spark.sql("SELECT is_overstay, count(*) AS n FROM fact_immigration f JOIN dim_visitor v ON f.visitor_id = v.visitor_id GROUP BY is_overstay")
    assert {r.is_overstay: r.n for r in sql.collect()} == {True: 2, False: 2}

    quarantine = spark.read.parquet(f"{rejected}/{schemas.REJECTED}")
    assert quarantine.columns == list(schemas.QUARANTINE_COLUMNS)
    assert quarantine.select("rejection_id").distinct().count() == 5
    assert quarantine.where("source_file like '%.parquet'").count() == 5
    assert quarantine.where("original_record.i94port = 'ZZ'").collect()[0].rejection_reason == "Invalid port code"
    summary = {r["Rejection Reason"]: r.Count for r in spark.read.parquet(f"{rejected}/{schemas.SUMMARY}").collect()}
    assert summary["Negative age value"] == 1 and sum(summary.values()) == 5
    metrics = {(r.metric, r.item): r.rows for r in spark.read.parquet(f"{out}/{schemas.METRICS}").collect()}
    assert metrics[("total", None)] == 9 and metrics[("rejected", None)] == 5


def test_quarantine_ids_stay_the_same(spark, paths):
    where = paths(*BAD.values(), {}, BAD["age"])
    ids = []
    for _ in range(2):
        etl.run(spark, *where)
        ids.append({r.rejection_id for r in spark.read.parquet(f"{where[3]}/{schemas.REJECTED}").collect()})
    assert len(ids[0]) == 6 and ids[0] == ids[1]


def test_rejections_of_an_earlier_run_go(spark, paths):
    where = paths({}, BAD["age"])
    assert etl.run(spark, *where).rows[schemas.REJECTED] == 1
    spark.read.parquet(where[0]).where("i94bir >= 0").coalesce(1).write.parquet(where[0] + "_good")
    again = etl.run(spark, where[0] + "_good", *where[1:])
    assert again.rows[schemas.REJECTED] == 0 and again.rows[schemas.SUMMARY] == 0
    for name in (schemas.REJECTED, schemas.SUMMARY):
        assert spark.read.parquet(f"{where[3]}/{name}").count() == 0


def test_reports_count_every_fact_once(spark, paths):
    posts = ("POST", "OTHER", None)
    late = {"arrdate": 30000.0, "depdate": 30010.0}
    rows = [{"cicid": float(i), "visapost": posts[i % 3], "i94visa": 1.0 + i % 2, **(late if i > 4 else {})} for i in range(9)]
    where = paths(*rows)
    for full_grain in (False, True):
        etl.run(spark, *where, visa_full_grain=full_grain)
        tables = reports.load(spark, where[2])
        assert sum(r.visitor_count for r in reports.visa_by_country(tables).collect()) == 9
        assert sum(r.visitor_count for r in reports.stay_by_port(tables).collect()) == 9
    etl.run(spark, *where, date_start="2016-01-01", date_end="2016-12-31", fmt="csv")
    tables = reports.load(spark, where[2], fmt="csv")
    assert tables[schemas.DIM_DATE].count() == 366 + 2
    assert sum(r.visitor_count for r in reports.stay_by_port(tables).collect()) == 9


def test_stage_lies_beside_the_output_without_a_shared_folder(spark, paths, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda spark, fallback: fallback)
    where = paths({}, BAD["age"])
    assert etl.run(spark, *where).rows["fact_immigration"] == 1
    assert not [name for name in os.listdir(where[2]) if name.startswith("_checked")]


def test_missing_columns_and_lookups(spark, paths):
    lookups = {name: text for name, text in LOOKUPS.items() if name != "i94prtl"}
    where = paths({}, BAD["age"], without=("depdate", "visatype", "visapost"), lookups=lookups)
    result = etl.run(spark, *where)
    assert result.skipped_rules == ["port", "dates"]
    assert result.skipped_tables == ["dim_visa", "dim_port"]
    assert spark.read.parquet(f"{where[2]}/{schemas.FACT}").columns == [
        "visitor_id",
        "arrival_date_id",
        "port_code",
        "travel_mode",
    ]


def test_unreadable_input_is_an_error(spark, paths):
    where = paths({})
    with pytest.raises(Exception):
        etl.run(spark, where[0] + "_nowhere", *where[1:])


def test_command_line(spark, paths):
    where = paths({}, {"arrdate": 20610.0, "depdate": None}, BAD["port"])
    names = ("--input-path", "--staging-path", "--output-path", "--rejected-path")
    options = [part for pair in zip(names, where) for part in pair]
    assert cli.main([*options, "--by-month", "--flat-quarantine", "--visa-full-grain", "--s3-bucket", "any"]) == 0
    fact = spark.read.parquet(f"{where[2]}/{schemas.FACT}")
    assert {r.arrival_month for r in fact.collect()} == {201604, 201606}
    flat = spark.read.parquet(f"{where[3]}/{schemas.REJECTED}")
    assert "i94port" in flat.columns and flat.collect()[0].i94port is None
    assert cli.main([*options, "--format", "csv"]) == 0
    assert spark.read.option("header", True).csv(f"{where[2]}/{schemas.DIM_PORT}").count() == 1
    with pytest.raises(SystemExit):
        cli.main([])
