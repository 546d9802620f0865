from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starmart.operators import joins


@pytest.fixture
def skewed(spark):
    """Half of the rows on one code, a quarter without one, the others on many; 'b' is hot where 'a' is not."""
    i = F.col("id")
    a = F.when(i % 4 < 2, F.lit(7)).when(i % 4 == 2, None).otherwise(100 + i % 997)
    b = F.when(i % 5 == 0, None).when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (i % 501).cast("string")))
    return spark.range(0, 40_000, 1, 8).select("id", a.cast("double").alias("a"), b.alias("b"), F.lit("x").alias("odd.name"))


@pytest.fixture
def large(spark):
    numbers = spark.range(2000).where("id % 10 <> 3").select(F.col("id").cast("string").alias("code"), F.concat(F.lit("n"), "id").alias("description"))
    texts = spark.range(400).select(F.concat(F.lit("c"), "id").alias("code"), F.when(F.col("id") > 5, F.lit("t")).alias("description"))
    return numbers, texts


@pytest.mark.parametrize("hot_parts,hot_rows", [(8, 10_000), (8, 1), (1, 1)])
def test_large_lookups_give_the_rows_of_small_ones(spark, skewed, large, monkeypatch, hot_parts, hot_rows):
    wanted = [("a", large[0], "first"), ("b", large[1], "second")]
    small = joins.attach_all(skewed, wanted)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    unmapped = joins.unmapped(skewed, "b", large[1])
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "HOT_PARTS", hot_parts)
    monkeypatch.setattr(joins, "HOT_ROWS", hot_rows)
    split = joins.attach_all(skewed, wanted)
    assert split.columns == small.columns == ["id", "a", "b", "odd.name", "first", "first_known", "second", "second_known"]
    assert sorted(map(tuple, split.collect()), key=str) == sorted(map(tuple, small.collect()), key=str)
    assert sorted(map(tuple, joins.unmapped(skewed, "b", large[1]).collect()), key=str) == sorted(map(tuple, unmapped.collect()), key=str)
    nothing = joins.attach_all(skewed.limit(0), wanted)
    assert nothing.count() == 0 and nothing.columns == small.columns
    missing = joins.attach(skewed.withColumn("a", F.lit(None).cast("double")), "a", large[0], "first")
    assert missing.where("first_known OR first IS NOT NULL").count() == 0 and missing.count() == 40_000


def test_hot_and_missing_codes_stay_out_of_the_shuffle(spark, skewed, large, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for wanted in ([("a", large[0], "first")], [("a", large[0], "first"), ("b", large[1], "second")]):
            split = joins.attach_all(skewed, wanted)
            tasks = {r.task: r["count"] for r in split.groupBy(F.spark_partition_id().alias("task")).count().collect()}
            sizes = sorted(rows for task, rows in tasks.items() if task >= 8)  # the first eight are those of the scan
            assert sum(tasks.values()) == 40_000 and max(tasks.values()) <= 5_000
            assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]
        plain = skewed.join(large[0], F.col("a").cast("long").cast("string") == F.col("code"), "left")
        sizes = sorted(r["count"] for r in plain.groupBy(F.spark_partition_id().alias("task")).count().collect())
        assert sizes[-1] > 2 * sizes[len(sizes) // 2]  # what a bare shuffle does
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_hinted_lookups_count_as_small(spark, large, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    assert joins.is_small(F.broadcast(large[0])) and not joins.is_small(large[0])


def test_lookups_without_an_estimate_are_measured(spark, monkeypatch):
    rows = spark.createDataFrame([(str(i), "x" * 10) for i in range(100)], "code string, description string").repartition(3)
    monkeypatch.setattr(joins, "estimated_bytes", lambda df: 1 << 60)
    assert joins.is_small(rows)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 7_000)
    assert not joins.is_small(rows)  # 100 rows of 64 bytes and 11 to 12 of text
