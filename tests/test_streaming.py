from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starmart import schemas
from starmart.operators import rules
from starmart.streaming import arrivals as stream
from tests.test_rules import BAD


def test_stream_agrees_with_batch(spark, named, arrivals, tmp_path):
    source, out, rejected, state = (str(tmp_path / name) for name in ("in", "out", "rejected", "state"))

    def feed(*changes):
        arrivals(*changes).coalesce(1).write.mode("append").parquet(source)
        query = stream.start(spark, source, named, out, rejected, state, availableNow=True)
        query.awaitTermination(120)
        assert query.exception() is None

    feed({}, {"cicid": 2.0}, BAD["port"])
    feed({"cicid": 3.0}, BAD["age"], BAD["residence"])
    fact = spark.read.parquet(f"{out}/{schemas.FACT}")
    assert sorted((r.visitor_id, r.batch_id) for r in fact.collect()) == [(1, 0), (2, 0), (3, 1)]
    kept = spark.read.parquet(f"{rejected}/{schemas.REJECTED}")
    assert sorted(r.rejection_reason for r in kept.collect()) == [
        "Invalid port code",
        "Negative age value",
        "Unknown country residence code",
    ]
    assert kept.where("original_record.i94port = 'ZZ'").count() == 1
    assert kept.select("rejection_id").distinct().count() == 3


def test_stream_refuses_rules_over_all_rows(spark, named, arrivals, tmp_path):
    arrivals({}).write.parquet(str(tmp_path / "in"))
    rule = rules.Rule("age", "Negative age value", F.col("i94bir") < 0, ("i94bir",), min_share=0.5)
    paths = [str(tmp_path / name) for name in ("out", "rejected", "state")]
    with pytest.raises(ValueError):
        stream.start(spark, str(tmp_path / "in"), named, *paths, rule_set=lambda df: [rule])


def test_rates_and_visitors_of_a_stream(spark, named, arrivals, tmp_path):
    """Three batches, with late rows and a visitor whose least row comes last: equal to one pass over all files."""
    from starmart.operators import dims
    from starmart.plans import etl
    from starmart.sources import arrivals as source

    where, out, rejected, state, watch = (str(tmp_path / name) for name in ("in", "out", "rejected", "state", "watch"))
    batches = (
        ({"i94bir": 40.0}, {"cicid": 2.0, "gender": None}, BAD["port"], {"arrdate": None}),
        ({"cicid": 3.0, "arrdate": 20590.0, "depdate": None}, {**BAD["age"], "arrdate": 20580.0}, {"i94bir": 35.0}),
        ({"i94bir": 30.0, "arrdate": 20560.0}, {**BAD["age"], "arrdate": 20573.0}, {**BAD["port"], "arrdate": None, "depdate": None}, {"cicid": 2.0}),
    )
    for changes in batches:
        arrivals(*changes).coalesce(1).write.mode("append").parquet(where)
        for query in (
            stream.start(spark, where, named, out, rejected, state, availableNow=True),
            stream.monitor(spark, where, named, out, watch, availableNow=True),
        ):
            query.awaitTermination(120)
            assert query.exception() is None
    checked, checks = etl.check(source.read(spark, where, schema=schemas.ARRIVALS, origin=True), named)
    rates = sorted(map(tuple, rules.rate_by_day(checked).collect()), key=str)
    assert len(rates) >= 4 and sorted(map(tuple, stream.daily_rates(spark, out).collect()), key=str) == rates
    want = sorted(map(tuple, dims.visitor(rules.split(checked, checks)[0], named).collect()))
    got = lambda: sorted(map(tuple, stream.visitors(spark, out, named).collect()))
    assert len(want) == 3 and got() == want
    batch = f"{out}/{stream.CHANGES}/batch_id=1"
    again = spark.read.parquet(batch).collect()
    for _ in range(2):
        stream.compact(spark, out)
        assert got() == want
    spark.createDataFrame(again, spark.read.parquet(f"{out}/{stream.CHANGES}").drop("batch_id").schema).write.mode("overwrite").parquet(batch)  # repeated
    assert got() == want


def test_rows_beyond_the_watermark_are_told(spark, named, arrivals, tmp_path):
    where, out, watch = (str(tmp_path / name) for name in ("in", "out", "watch"))
    dropped = 0
    for day in (20573.0, 20700.0, 20701.0, 20573.0):
        arrivals({**BAD["port"], "arrdate": day, "depdate": None}).coalesce(1).write.mode("append").parquet(where)
        query = stream.monitor(spark, where, named, out, watch, lateness="10 days", availableNow=True)
        query.awaitTermination(120)
        dropped += sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    assert dropped == 1 and [r.rows for r in stream.daily_rates(spark, out).orderBy("arrdate_dt").collect()] == [1, 1, 1]
