"""The three reports over the star tables; `tables` maps table names to frames.

The visitor table grows with the facts, so arrivals are counted per visitor before they meet it: every task hands
on one row per visitor, or few, however many arrivals one of them has. That table is never broadcast, however small
its files look: the join is told to merge. Port and date tables go to every executor if their
size allows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import schemas
from starmart.functions import bands, dates
from starmart.operators.joins import sized
from starmart.sources import runs

Tables = Mapping[str, DataFrame]


def load(
    spark: SparkSession, path: str, names: tuple[str, ...] | None = None, fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Written star tables by name; each is also a temporary view, ready for SQL text. `fmt` is the job's format.

    The tables are those of one run: a publication that broke off is finished first.
    """
    runs.settle(spark, path)
    tables = {}
    for name in names or (
        schemas.FACT,
        schemas.DIM_DATE,
        schemas.DIM_VISITOR,
        schemas.DIM_VISA,
        schemas.DIM_PORT,
    ):
        reader = spark.read.options(header=True, inferSchema=True) if fmt == "csv" else spark.read
        tables[name] = reader.format(fmt).load(f"{path.rstrip('/')}/{name}")
        tables[name].createOrReplaceTempView(name)
    return tables


def visa_by_country(tables: Tables, per_code: bool = True) -> DataFrame:
    """Arrivals by country of citizenship and visa purpose.

    Facts are shuffled once, by visitor, and adaptive execution splits a visitor with most of them, since nothing
    but the join needs them together. Counts are down to countries and types before the visa table comes in. Of the rows
    that a type may have there, the first with a category gives the purpose, so every fact counts once; without
    `per_code` it counts once for each of them.
    """
    visitors = tables[schemas.DIM_VISITOR].select("visitor_id", "country_of_citizenship").hint("merge")
    visas = tables[schemas.DIM_VISA].withColumnRenamed("visa_code", "visatype")
    purposes = visas.select("visatype", "visa_purpose")
    if per_code:
        first = [F.col("visa_category").isNull(), "visa_category"] if "visa_category" in visas.columns else []
        pick = F.min(F.struct(*first, "visa_purpose")).alias("pick")
        purposes = visas.groupBy("visatype").agg(pick).select("visatype", "pick.visa_purpose")
    by_type = (
        tables[schemas.FACT]
        .select("visitor_id", "visatype")
        .join(visitors, "visitor_id")
        .groupBy("country_of_citizenship", "visatype")
        .agg(F.count(F.lit(1)).alias("arrivals"))
    )
    return (
        by_type.join(purposes, "visatype")
        .groupBy("country_of_citizenship", "visa_purpose")
        .agg(F.sum("arrivals").alias("visitor_count"))
        .orderBy("country_of_citizenship", F.desc("visitor_count"))
    )


def stay_by_port(tables: Tables, port_bound: DataFrame | None = None) -> DataFrame:
    """Average stay in days and arrivals by city and state of the port, for those who left."""
    fact = tables[schemas.FACT].select("port_code", "arrival_date_id", "departure_date_id")
    ports = tables[schemas.DIM_PORT].select("port_code", "city", "state")
    days = tables[schemas.DIM_DATE]
    arrival = days.select(F.col("date_id").alias("arrival_date_id"), F.col("full_date").alias("arrived"))
    departure = days.select(F.col("date_id").alias("departure_date_id"), F.col("full_date").alias("departed"))
    return (
        fact.where("departure_date_id is not null")
        .join(sized(ports, port_bound), "port_code")
        .join(sized(arrival), "arrival_date_id")
        .join(sized(departure), "departure_date_id")
        .groupBy("city", "state")
        .agg(
            F.avg(dates.stay_days(F.col("arrived"), F.col("departed"))).alias("avg_stay_days"),
            F.count(F.lit(1)).alias("visitor_count"),
        )
        .orderBy(F.desc("avg_stay_days"))
    )


# How many arrivals of a visitor have each value of the flag.
_FLAG_COUNTS = {"true": True, "false": False, "unknown": None}


def overstay_by_age(tables: Tables) -> DataFrame:
    """Arrivals by country of citizenship, age band and overstay flag.

    Each value of the flag is a count of its own until the end, so arrivals are shuffled by visitor only once.
    """
    visitors = tables[schemas.DIM_VISITOR].select(
        "visitor_id", "country_of_citizenship", bands.age_band(F.col("age")).alias("age_group")
    ).hint("merge")
    flag = F.col("is_overstay")
    per_visitor = (
        tables[schemas.FACT]
        .groupBy("visitor_id")
        .agg(*[F.count_if(flag.eqNullSafe(F.lit(value))).alias(name) for name, value in _FLAG_COUNTS.items()])
    )
    per_group = (
        per_visitor.join(visitors, "visitor_id")
        .groupBy("country_of_citizenship", "age_group")
        .agg(*[F.sum(name).alias(name) for name in _FLAG_COUNTS])
    )
    entries = [
        F.struct(F.lit(value).cast("boolean").alias("is_overstay"), F.col(name).alias("visitor_count"))
        for name, value in _FLAG_COUNTS.items()
    ]
    return (
        per_group.select("country_of_citizenship", "age_group", F.inline(F.array(*entries)))
        .where("visitor_count > 0")
        .orderBy("country_of_citizenship", "age_group")
    )
