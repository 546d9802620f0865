"""Dimension tables."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import schemas
from starmart.functions import codes, dates, places, visas
from starmart.operators.joins import attach, described, sized
from starmart.sources.lookups import Lookups


# Days the date table holds in any case; those of the facts are added.
DATE_START, DATE_END = "1960-01-01", "2030-01-01"


def date(
    spark: SparkSession, start: str = DATE_START, end: str = DATE_END, clean: DataFrame | None = None
) -> DataFrame:
    """One row per day from start to end, both included, and per other day that `clean` rows arrive or depart on."""
    first, last = Date.fromisoformat(start), Date.fromisoformat(end)
    day = F.col("full_date")
    days = spark.range((last - first).days + 1).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("full_date"))
    if clean is not None:
        days = days.unionByName(days_of(clean).where(~day.between(F.lit(first), F.lit(last))))
    return (
        days.select(
            dates.date_id(day).alias("date_id"),
            day,
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.dayofmonth(day).alias("day"),
            F.dayofweek(day).alias("day_of_week"),
            F.date_format(day, "EEEE").alias("weekday_name"),
            F.dayofweek(day).isin(1, 7).alias("is_weekend"),
            F.quarter(day).alias("quarter"),
        )
    )


def days_of(clean: DataFrame) -> DataFrame:
    """Days on which rows arrive or depart, each once."""
    ids = [F.col(c) for c in ("arrival_date_id", "departure_date_id") if c in clean.columns]
    listed = clean.select(F.explode(F.array(*ids, F.lit(None).cast("int"))).alias("id")).where("id is not null").distinct()
    return listed.select(F.expr("make_date(id div 10000, id div 100 % 100, id % 100)").alias("full_date"))


# Visitor columns taken from the arrivals: target, source. Codes and gender stay as they are, the rest are numbers.
_VISITOR_SOURCES = (
    ("country_of_citizenship_code", "i94cit"),
    ("country_of_residence_code", "i94res"),
    ("age", "i94bir"),
    ("biryear", "biryear"),
    ("gender", "gender"),
)
_WHOLE = ("age", "biryear")
_COUNTRIES = ("country_of_citizenship", "country_of_residence")


def visitor(clean: DataFrame, lookups: Lookups) -> DataFrame:
    """One row per visitor.

    Of several rows with one id the smallest stays, compared column by column. Every task hands on one row per
    id, so an id that fills a third of the table is no burden; codes become text and meet their country names
    only on the rows that are left.
    """
    return named_people(people(clean), lookups)


def people(clean: DataFrame) -> DataFrame:
    """visitor_id and `person`, the smallest of its rows as a struct; the id alone where no other column is at hand."""
    if "cicid" not in clean.columns:
        raise ValueError("the data has no visitor id (cicid)")
    columns = [
        (codes.to_whole(clean, source, "int") if target in _WHOLE else F.col(source)).alias(target)
        for target, source in _VISITOR_SOURCES
        if source in clean.columns
    ]
    visitor_id = codes.to_whole(clean, "cicid", "bigint").alias("visitor_id")
    if not columns:
        return clean.select(visitor_id).distinct()
    return merged_people(clean.select(visitor_id, F.struct(*columns).alias("person")))


def merged_people(parts: DataFrame) -> DataFrame:
    """One row per visitor of several parts: the least of least rows is the least of all, however they were split."""
    if "person" not in parts.columns:
        return parts.select("visitor_id").distinct()
    return parts.groupBy("visitor_id").agg(F.min("person").alias("person"))


def named_people(people: DataFrame, lookups: Lookups) -> DataFrame:
    """The visitor table of merged people."""
    if "person" not in people.columns:
        return people
    people = people.select("visitor_id", "person.*")
    for country in _COUNTRIES:
        code = f"{country}_code"
        if code in people.columns:
            if schemas.COUNTRY in lookups:
                people = with_country(people, code, lookups[schemas.COUNTRY], country)
            people = people.withColumn(code, codes.code_of(people, code))
    return people.select([c for c in schemas.VISITOR_COLUMNS if c in people.columns])


def with_country(df: DataFrame, code: str, lookup: DataFrame, into: str, show_code: bool = False) -> DataFrame:
    """Country name of a code, 'Unknown' when missing or not in the lookup.

    With `show_code` a code that is not in the lookup reads 'Unknown(148.0)'.
    """
    named = attach(df, code, lookup, "_country")
    label = F.lit(codes.UNKNOWN)
    if show_code:
        text = F.format_string(f"{codes.UNKNOWN}(%s)", F.col(code).cast("string"))
        label = F.when(codes.is_missing(df, code), label).otherwise(text)
    name = described(F.col("_country"), F.col("_country_known"), label)
    return named.withColumn(into, name).drop("_country", "_country_known")


def visa_posts(clean: DataFrame) -> DataFrame:
    """Visa types with their issuing posts; a missing post becomes 'Unknown' after they are told apart."""
    if "visapost" not in clean.columns:
        return clean.select("visatype").distinct().withColumn("visapost", F.lit(codes.UNKNOWN))
    posts = clean.select("visatype", "visapost").distinct()
    return posts.withColumn("visapost", F.coalesce("visapost", F.lit(codes.UNKNOWN)))


def visa_classes(clean: DataFrame) -> DataFrame:
    """Visa types with the categories of their classes; classes are told apart before they become categories."""
    classes = clean.select("visatype", "i94visa").distinct()
    return classes.select("visatype", visas.visa_category(F.col("i94visa")).alias("visa_category"))


def visa(clean: DataFrame) -> DataFrame:
    """Visa types by issuing post and category: a row for each post and each category of a type.

    The grain of the job's own table. Types repeat, and so do whole rows: posts are told apart before a missing
    one becomes 'Unknown', and classes before they become categories.
    """
    purpose = visas.visa_purpose(F.col("visatype"))
    types = visa_posts(clean)
    if "i94visa" in clean.columns:
        types = types.join(visa_classes(clean), "visatype", "left")
    else:
        types = types.withColumn("visa_category", F.lit(None).cast("string"))
    rows = types.select(
        F.col("visatype").alias("visa_code"),
        F.col("visapost").alias("visa_issuing_post"),
        visas.refine_purpose(purpose, F.col("visa_category")).alias("visa_purpose"),
        "visa_category",
    )
    return with_unknown_member(rows, clean)


def _unknown_member(clean: DataFrame) -> DataFrame:
    unknown = F.lit(codes.UNKNOWN)
    return clean.sparkSession.range(1).select(
        unknown.alias("visa_code"),
        unknown.alias("visa_issuing_post"),
        unknown.alias("visa_purpose"),
        F.lit(None).cast("string").alias("visa_category"),
    )


def with_unknown_member(visa_rows: DataFrame, clean: DataFrame) -> DataFrame:
    """Add the row of the 'Unknown' visa type unless `clean` rows have that type; one flag decides, within the plan."""
    present = clean.select(F.bool_or(F.col("visatype") == codes.UNKNOWN)).scalar()
    return visa_rows.unionByName(_unknown_member(clean).where(~F.coalesce(present, F.lit(False))))


def visa_by_code(clean: DataFrame) -> DataFrame:
    """One row per visa type, as the table's key says: joining it never multiplies rows.

    The first post in order stands for the type; a row with a category goes before one without. One aggregate gives
    a row per type; the 'Unknown' type, added to these few rows, gives way to one that the data has.
    """
    unknown, none = F.lit(codes.UNKNOWN), F.lit(None).cast("string")
    post = F.coalesce("visapost", unknown) if "visapost" in clean.columns else unknown
    category = visas.visa_category(F.col("i94visa")) if "i94visa" in clean.columns else none
    purpose = visas.refine_purpose(visas.visa_purpose(F.col("visatype")), category)
    types = (
        clean.select(F.col("visatype").alias("visa_code"), post.alias("post"), category.alias("visa_category"), purpose.alias("visa_purpose"))
        .groupBy("visa_code")
        .agg(
            F.min("post").alias("visa_issuing_post"),
            F.min(F.struct(F.col("visa_category").isNull(), "visa_category", "visa_purpose")).alias("pick"),
        )
        .select("visa_code", "visa_issuing_post", "pick.visa_purpose", "pick.visa_category", F.lit(0).alias("added"))
    )
    rest = ("visa_issuing_post", "visa_purpose", "visa_category")
    return (
        types.unionByName(_unknown_member(clean).withColumn("added", F.lit(1)))
        .groupBy("visa_code")
        .agg(F.min(F.struct("added", *rest)).alias("row"))
        .select("visa_code", *[f"row.{c}" for c in rest])
    )


def port(clean: DataFrame, lookups: Lookups) -> DataFrame:
    """Ports that occur in the data and are in the lookup, with city and state from the description."""
    lookup = lookups[schemas.PORT]
    used = clean.select(F.col("i94port").alias("port_code")).where("port_code is not null").distinct()
    named = used.join(sized(lookup.withColumnRenamed("code", "port_code")), "port_code")
    place = places.place_parts(F.col("description"))
    return named.select("port_code", F.col("description").alias("port_of_entry"), F.inline(F.array(place)))
