"""Every check against its SQL twin, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as spec
from checks import registry
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_check(spark, con, name):
    assert difference(spec.queries()[name](spark, SF_DIR), con, spec.oracle_sql()[name]) is None


def test_every_check_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_expected_counts(spark):
    reasons = {r["Rejection Reason"]: r.Count for r in spec.queries()["a1_rejection_summary"](spark, SF_DIR).collect()}
    assert reasons == {
        "Unknown country residence code": 131,
        "Unknown country citizenship code": 100,
        "Negative age value": 13,
        "Departure date before arrival date": 20,
        "Invalid port code": 84,
    }
    hits = {r.rule: r.rows for r in spec.queries()["v9_rule_counts"](spark, SF_DIR).collect()}
    assert hits == {"port": 98, "dates": 24, "age": 14, "citizenship": 126, "residence": 131}
    assert spec.queries()["b3_visa_dim"](spark, SF_DIR).count() == 120
    assert spec.queries()["b4_port_dim"](spark, SF_DIR).count() == 24
    assert spec.entry(spark).columns == ["country_of_citizenship", "visa_purpose", "visitor_count"]


def test_rule_checks_move_no_arrivals(spark):
    """Lookups are broadcast: nothing is shuffled by a code."""
    plan = registry.data(spark, SF_DIR, "k").flagged._jdf.queryExecution().executedPlan().toString()
    for code in ("i94port", "i94cit", "i94res", "i94mode"):
        assert f"hashpartitioning({code}" not in plan and f"hashpartitioning(cast({code}" not in plan
    assert "SortMergeJoin [i94port" not in plan
