from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.operators import profile
from starmart.operators.quantiles import exact_quantiles


def numbers(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


@pytest.mark.parametrize("seed, size, spread", [(1, 1, 5), (2, 2, 5), (3, 1000, 10), (4, 5000, 1_000_000), (5, 3001, 300)])
def test_quantiles_match_numpy(spark, seed, size, spread):
    values = np.random.default_rng(seed).integers(-spread, spread, size).astype(float)
    shares = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(numbers(spark, values), "x", shares).collect()[0]
    assert list(got) == pytest.approx(list(np.quantile(values, shares)))


def test_quantiles_with_a_hot_value_and_an_outlier(spark):
    values = [7.0] * 2000 + list(range(1000)) + [1e12]
    got = exact_quantiles(numbers(spark, values), "x", [0.25, 0.5, 0.9]).collect()[0]
    assert list(got) == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.9])))


def test_quantiles_of_extremes(spark):
    values = [-math.inf, -1.7e308, 5e-324, 1e-323, 0.0, 1.7e308, math.inf, None]
    got = exact_quantiles(numbers(spark, values), "x", [i / 6 for i in range(7)]).collect()[0]
    assert list(got) == sorted(v for v in values if v is not None)


def test_quantiles_shuffle_no_values(spark):
    """However many different values there are, a pass returns at most so many parts of so many ranges."""
    df = spark.range(200_000).select((F.col("id") * 0.37).alias("x"))
    assert list(exact_quantiles(df, "x", [0.25, 0.5]).collect()[0]) == pytest.approx([199_999 * 0.37 * q for q in (0.25, 0.5)])


def test_quantiles_of_nothing(spark):
    assert list(exact_quantiles(numbers(spark, []), "x", [0.5]).collect()[0]) == [None]


def test_describe(spark):
    row = profile.describe(numbers(spark, [1, 2, 3, 4, None, math.nan]), "x").collect()[0]
    assert (row["count"], row.mean, row.min, row.p25, row.p50, row.p75, row.max) == (4, 2.5, 1, 1.75, 2.5, 3.25, 4)
    assert row.std == pytest.approx(np.std([1, 2, 3, 4], ddof=1))
    rough = profile.describe(numbers(spark, range(101)), "x", approximate=True).collect()[0]
    assert (rough.p25, rough.p50, rough.p75) == (25, 50, 75)


def test_null_profile_counts_nan_as_missing(spark):
    rows = spark.createDataFrame([(1.0, "a"), (math.nan, None), (None, None), (2.0, None)], "x double, s string")
    got = {r.column: (r.missing, r.missing_percent) for r in profile.nulls(rows).collect()}
    assert got == {"x": (2, 50.0), "s": (3, 75.0)}
    assert [r.column for r in profile.mostly_missing(profile.nulls(rows), 60).collect()] == ["s"]


def test_value_counts_percent_and_top(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "s string")
    counts = profile.with_percent(profile.value_counts(rows, "s"))
    assert {r.s: (r["count"], r.percentage) for r in counts.collect()} == {"a": (1, 25.0), "b": (2, 50.0), "c": (1, 25.0)}
    assert [r.s for r in profile.top(profile.value_counts(rows, "s"), 2).collect()] == ["b", "a"]
    assert {r.s for r in profile.value_counts(rows, "s", missing_as="NA").collect()} == {"a", "b", "c", "NA"}


def test_sentinels_domain_distinct_non_numeric(spark):
    rows = numbers(spark, [0, 0, 1, 2, 5, None, -999])
    assert {r.value: r.rows for r in profile.sentinels(rows, "x").collect()} == {"-999": 1, "-1": 0, "0": 2, "999": 0}
    got = {r.status: (r["count"], round(r.percentage, 2)) for r in profile.domain_check(rows, "x", [1, 2, 3]).collect()}
    assert got == {"Valid": (2, 28.57), "NA/Missing": (1, 14.29), "Invalid": (4, 57.14)}
    assert {(r.status, r.value): r["count"] for r in profile.domain_values(rows, "x", [1, 2, 3]).collect()}[("Invalid", 0.0)] == 2
    assert [(r.value, r.distinct_values) for r in profile.distinct_values(rows, "x", 2).collect()] == [(-999.0, 6), (0.0, 6)]
    assert profile.approx_distinct(rows, "x").collect()[0].distinct_values == 5
    text = spark.createDataFrame([("1",), ("x",), (None,), ("2.5",)], "s string")
    assert profile.non_numeric(text, "s").collect()[0].non_numeric == 1


@pytest.mark.parametrize("values, bins", [([0, 1, 2, 3, 4, 10], 5), ([5, 5, 5], 3), (list(range(0, 180, 7)), 30)])
def test_histogram_matches_numpy(spark, values, bins):
    rows = profile.histogram(numbers(spark, values + [None]), "x", bins).orderBy("bin").collect()
    if len(set(values)) > 1:
        counts, edges = np.histogram(values, bins=bins)
        assert [r["count"] for r in rows] == list(counts)
        assert [r["from"] for r in rows] == pytest.approx(list(edges[:-1]))
    else:
        assert [r["count"] for r in rows] == [3, 0, 0]


def test_histogram_limits(spark):
    rows = numbers(spark, [-200, -180, -10, -1, 0])
    assert sum(r["count"] for r in profile.histogram(rows, "x", 4, lo=-180, hi=-1, open_lo=True).collect()) == 2
    assert sum(r["count"] for r in profile.histogram(rows, "x", 4, lo=-180, hi=-1).collect()) == 3


def test_country_names_for_reading(spark, named):
    rows = spark.createDataFrame([("101",), ("7",), ("x1",), (None,)], "c string")
    got = {r.c: r.country_name for r in profile.with_country_name(rows, "c", named["i94cntyl"]).collect()}
    assert got == {"101": "AVALON", "7": "Unknown (7)", "x1": "Invalid code format (x1)", None: "NA"}
    rows = numbers(spark, [101, 7, None, math.nan])
    got = [r.country_name for r in profile.with_country_name(rows, "x", named["i94cntyl"]).collect()]
    assert sorted(got) == ["AVALON", "NA", "NA", "Unknown (7)"]
    totals = profile.mapping_totals(rows, "x", named["i94cntyl"]).collect()[0]
    assert (totals.rows, totals.na_values, totals.unknown_codes) == (4, 2, 1)


def test_unlisted_codes(spark, named):
    rows = numbers(spark, [101, 7, 7, None])
    left = profile.not_in_lookup(rows, "x", named["i94cntyl"])
    assert [(r.x, r["count"]) for r in profile.value_counts(left, "x").collect()] == [(7.0, 2)]
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan


def test_shares_need_no_cross_join(spark):
    counts = profile.with_percent(profile.value_counts(spark.range(10).select((F.col("id") % 3).alias("k")), "k"))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_describe_all_takes_no_more_passes_than_its_slowest_column(spark, monkeypatch):
    from starmart.operators import quantiles

    rows = [(float(i * 37 % 1009) / 7, i % 5, None, str(i) if i % 3 else "x", math.nan if i % 2 else math.inf) for i in range(1500)]
    df = spark.createDataFrame(rows, "a double, b int, c double, `d.e` string, f double")
    passes, counted = [], quantiles._counted
    monkeypatch.setattr(quantiles, "_counted", lambda *args: passes.append(1) or counted(*args))
    names = ["a", "b", "c", "f"]
    single, most = [], 0
    for name in names:
        passes.clear()
        single += [tuple(r) for r in profile.describe(df, name).collect()]
        most = max(most, len(passes))
    passes.clear()
    together = [tuple(r) for r in profile.describe_all(df, names).collect()]
    assert str(together) == str(single) and 0 < len(passes) == most
