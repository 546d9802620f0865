from __future__ import annotations

import math
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from starmart.operators import rules
from starmart.operators.enrich import enrich
from starmart.plans import etl

BAD = {
    "port": {"i94port": "ZZ"},
    "dates": {"depdate": 20570.0},
    "age": {"i94bir": -1.0},
    "citizenship": {"i94cit": 999.0},
    "residence": {"i94res": 999.0},
}


def flagged(arrivals, named, *changes, **options):
    return etl.check(arrivals(*changes, **options), named)


@pytest.mark.parametrize("rule", BAD)
def test_each_rule_rejects(arrivals, named, rule):
    df, checks = flagged(arrivals, named, BAD[rule])
    row = df.collect()[0]
    assert row.is_rejected
    assert row.rejection_reason == next(c.reason for c in checks if c.name == rule)
    assert [c.name for c in checks if row[c.flag]] == [rule]


def test_valid_and_missing_values_pass(arrivals, named):
    df, _ = flagged(
        arrivals,
        named,
        {},
        {"i94port": None},
        {"i94cit": None, "i94res": math.nan},
        {"i94cit": 0.0},
        {"i94cit": 101.9},
        {"depdate": None},
        {"arrdate": None},
        {"i94bir": None},
        {"depdate": 20573.0},
    )
    assert [r.is_rejected for r in df.collect()] == [False] * 9
    assert {r.rejection_reason for r in df.collect()} == {None}


def test_a_code_that_is_no_number_is_rejected(arrivals, named):
    df, _ = flagged(arrivals, named, {"i94cit": math.inf})
    assert df.collect()[0].rejection_reason == "Unknown country citizenship code"


def test_last_rule_gives_the_reason_and_all_are_counted(arrivals, named):
    df, checks = flagged(arrivals, named, {**BAD["port"], **BAD["age"], **BAD["residence"]}, {**BAD["port"], **BAD["age"]})
    assert [r.rejection_reason for r in df.orderBy("i94res").collect()] == [
        "Negative age value",
        "Unknown country residence code",
    ]
    counts = {r.rule: r.rows for r in rules.rule_counts(df, checks).collect()}
    assert counts == {"port": 2, "dates": 0, "age": 2, "citizenship": 0, "residence": 1}


def test_repairs_touch_rejected_rows_only_where_the_rule_broke(arrivals, named):
    df, checks = flagged(arrivals, named, BAD["port"], BAD["dates"], BAD["age"], {})
    clean, rejected = rules.split(df, checks)
    rows = {r.rejection_reason: r for r in rejected.collect()}
    assert rows["Invalid port code"].i94port is None and rows["Invalid port code"].i94bir == 30.0
    late = rows["Departure date before arrival date"]
    assert late.departure_date_id is None and late.arrival_date_id == 20160429 and late.i94port == "P1"
    assert rows["Negative age value"].i94bir is None
    assert clean.count() == 1
    assert not {"is_rejected", "rejection_reason", "original_record", "port_name"} & set(clean.columns)


def test_order_of_rules_changes_the_reason_only(arrivals, named):
    raw = arrivals({}, *BAD.values(), {**BAD["port"], **BAD["residence"]})
    enriched = enrich(raw, named)
    base = rules.default_rules(enriched)
    seen = set()
    for order in list(permutations(base))[::29]:
        seen.add(tuple(r.is_rejected for r in rules.flag(enriched, order).collect()))
    assert seen == {(False, True, True, True, True, True, True)}


def test_rules_without_their_column_or_lookup_are_skipped(arrivals, named):
    only_modes = {"i94model": named["i94model"]}
    df, checks = flagged(arrivals, only_modes, BAD["port"], BAD["age"], BAD["citizenship"], without=("depdate",))
    assert [r.name for r in rules.active(df, checks)] == ["age"]
    assert sorted(r.is_rejected for r in df.collect()) == [False, False, True]
    skipped = {r.item for r in rules.metrics(df, checks).where("metric = 'skipped'").collect()}
    assert skipped == {"port", "dates", "citizenship", "residence"}
    assert "is_overstay" not in df.columns


def test_metrics_agree_with_rows(arrivals, named):
    df, checks = flagged(arrivals, named, {}, {}, *BAD.values(), {**BAD["age"], **BAD["port"]})
    got = {(r.metric, r.item): r.rows for r in rules.metrics(df, checks).collect()}
    assert got[("total", None)] == 8 and got[("rejected", None)] == 6
    assert got[("rule", "age")] == 2 and got[("rule", "port")] == 2
    assert sum(n for (metric, _), n in got.items() if metric == "reason") == 6
    clean, rejected = rules.split(df, checks)
    assert clean.count() + rejected.count() == 8
    assert sum(r.Count for r in rules.summary(rejected).collect()) == 6


def test_min_share(arrivals, named):
    def strict(share):
        return lambda df: [
            rules.Rule("age", "Negative age value", F.col("i94bir") < 0, ("i94bir",), ("i94bir",), min_share=share)
        ]

    raw = arrivals({}, {}, {}, BAD["age"])
    rejected = [etl.check(raw, named, strict(s))[0].where("is_rejected").count() for s in (0.2, 0.25, 0.3)]
    assert rejected == [1, 1, 0]


def test_quarantine_keeps_the_record_as_it_came(arrivals, named):
    df, checks = flagged(arrivals, named, {**BAD["port"], "visatype": None})
    row = rules.quarantine(rules.split(df, checks)[1]).collect()[0]
    assert row.original_record.i94port == "ZZ" and row.original_record.visatype is None
    assert row.is_rejected and row.rejection_reason == "Invalid port code"
    assert row.rejection_timestamp is not None and row.source_file is None and len(row.rejection_id) == 64
    flat = rules.quarantine_flat(rules.split(df, checks)[1]).collect()[0]
    assert flat.i94port is None and flat.visatype == "Unknown" and flat.travel_mode == "Air"
    assert "original_record" not in flat


def test_rate_by_day(arrivals, named):
    df, _ = flagged(arrivals, named, {}, BAD["age"], BAD["port"], {"arrdate": 20574.0})
    got = {(str(r.arrdate_dt), r.rejection_reason): (r.rows, r.percent) for r in rules.rate_by_day(df).collect()}
    assert len(got) == 2 and got[("2016-04-29", "Negative age value")] == (1, pytest.approx(100 / 3))


def test_metrics_of_an_empty_table(arrivals, named):
    df, checks = etl.check(arrivals({}).limit(0), named)
    got = {(r.metric, r.item): r.rows for r in rules.metrics(df, checks).collect()}
    assert got == {("total", None): 0, ("rejected", None): 0, **{("rule", c.name): 0 for c in checks}, ("missing", "visa_type"): 0, ("missing", "departure"): 0}


def test_text_ages_break_nothing(arrivals, named):
    rows = arrivals({}, {"cicid": 2.0}).withColumn("i94bir", F.when(F.col("cicid") == 2.0, "n/a").otherwise("-3"))
    df, checks = etl.check(rows, named)
    assert {r.rule: r.rows for r in rules.rule_counts(df, checks).collect()}["age"] == 1
