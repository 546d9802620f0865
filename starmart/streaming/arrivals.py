"""Checks new arrival files as they come in and appends facts and rejected rows.

The rules look at one row and the lookups only, so no state is kept and nothing can come too late. Visitors of each
batch are kept beside the facts as their least rows; `visitors` merges them into the visitor table. The other
dimension tables are built by the batch job. `monitor` is a stream of its own that counts rejections by day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starmart import schemas, session
from starmart.operators import dims, fact, rules
from starmart.plans import etl
from starmart.sources import arrivals
from starmart.sources.lookups import Lookups


# Least rows of visitors by batch, and counts by day: folders beside the facts.
CHANGES, COUNTS = "visitor_changes", "rejection_counts"


def start(
    spark: SparkSession,
    input_path: str,
    named: Lookups,
    output_path: str,
    rejected_path: str,
    checkpoint_path: str,
    schema: T.StructType = schemas.ARRIVALS,
    rule_set: etl.RuleSet = rules.default_rules,
    files_per_trigger: int = 1000,
    **trigger,
) -> StreamingQuery:
    """Start the stream; `trigger` goes to `DataStreamWriter.trigger`, e.g. `availableNow=True`.

    Each batch writes to its own folder `batch_id=N`, which a repeated batch overwrites: after a failure every row
    is there once. Both outputs are read from the files of the batch, `files_per_trigger` at most: the rules need no
    shuffle, so checking twice costs less than holding a batch somewhere.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    raw = arrivals.with_origin(reader.parquet(input_path))
    checked, checks = etl.check(raw, named, rule_set)
    staged = etl.staged_columns(checked, checks)

    def write(batch: DataFrame, batch_id: int) -> None:
        clean, rejected = rules.split(batch, checks)
        outputs = [
            (fact.arrivals(clean), f"{output_path}/{schemas.FACT}"),
            (rules.quarantine(rejected), f"{rejected_path}/{schemas.REJECTED}"),
        ]
        if "cicid" in clean.columns:
            outputs.append((dims.people(clean), f"{output_path}/{CHANGES}"))
        for rows, path in outputs:
            rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = staged.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_path)
    return (writer.trigger(**trigger) if trigger else writer).start()


def visitors(spark: SparkSession, output_path: str, named: Lookups) -> DataFrame:
    """The visitor table of all batches so far: what `dims.visitor` makes of all their clean rows.

    The least of the batches' least rows is the least of all, so neither the split into batches nor a batch that was
    repeated matters.
    """
    return dims.named_people(dims.merged_people(spark.read.parquet(f"{output_path}/{CHANGES}").drop("batch_id")), named)


def compact(spark: SparkSession, output_path: str) -> None:
    """Merge the visitors of all batches so far into one folder, so that reading them stays cheap.

    The merged rows are written first and their sources removed after; until then, or if that breaks off, a visitor
    is there twice with rows of which the least is the same. A batch that is repeated later does no harm either.
    """
    path = f"{output_path}/{CHANGES}"
    parts = spark.read.parquet(path)
    merged = [r.batch_id for r in parts.select("batch_id").distinct().collect()]
    into = min([*merged, 0]) - 1  # batches count up from 0, merged folders down from -1
    dims.merged_people(parts.drop("batch_id")).write.mode("overwrite").parquet(f"{path}/batch_id={into}")
    for batch in merged:
        session.remove(spark, f"{path}/batch_id={batch}")


def monitor(
    spark: SparkSession,
    input_path: str,
    named: Lookups,
    output_path: str,
    checkpoint_path: str,
    lateness: str = "60 days",
    schema: T.StructType = schemas.ARRIVALS,
    rule_set: etl.RuleSet = rules.default_rules,
    files_per_trigger: int = 1000,
    **trigger,
) -> StreamingQuery:
    """Start a stream that keeps rejections counted by arrival day and reason; `daily_rates` reads them.

    Counts are state by event time: a day is open until rows come that arrived `lateness` after it, then its state
    goes and its counts stay as written. Rows that are later than that are not counted; the progress of the query
    tells how many (`numRowsDroppedByWatermark`). Rows without a day are counted as such and never close. Each batch
    writes the counts that it changed to its own folder, which a repeated batch overwrites.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    checked, _ = etl.check(arrivals.with_origin(reader.parquet(input_path)), named, rule_set)
    counts = (
        checked.select(F.col("arrdate_dt").cast("timestamp").alias("day"), "rejection_reason")
        .withWatermark("day", lateness)
        .groupBy("day", "rejection_reason")
        .agg(F.count(F.lit(1)).alias("rows"))
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output_path}/{COUNTS}/batch_id={batch_id}")

    writer = counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint_path)
    return (writer.trigger(**trigger) if trigger else writer).start()


def daily_rates(spark: SparkSession, output_path: str) -> DataFrame:
    """Rejections per day and reason with their share of the day's rows, as `rules.rate_by_day`, from the latest counts."""
    counts = spark.read.parquet(f"{output_path}/{COUNTS}")
    latest = counts.groupBy("day", "rejection_reason").agg(F.max_by("rows", "batch_id").alias("rows"))
    return rules.rates(latest.select(F.col("day").cast("date").alias("arrdate_dt"), "rejection_reason", "rows"))
