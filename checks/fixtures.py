"""Arrivals and lookups derived from the given tables, as SQL both engines read.

Every order is an arrival. Nulls, unlisted codes and rule violations come from arithmetic on its keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart import schemas
from starmart.operators.joins import sized
from starmart.sources.lookups import Lookups, unique

DAY_SPARK = "datediff(CAST(o_orderdate AS DATE), DATE '1960-01-01')"
DAY_DUCK = "datediff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE))"

# Days added to some arrivals of the late tables, which then reach beyond the usual days of a date table.
LATE = "CASE WHEN o_orderkey % 10 < 4 THEN 16000 ELSE 0 END"

_ARRIVALS = """
SELECT CAST({visitor} AS DOUBLE) AS cicid,
       CAST(CASE WHEN k % 211 = 0 THEN NULL WHEN k % 223 = 0 THEN 0 WHEN k % 227 = 0 THEN 999
                 ELSE 100 + nk END AS DOUBLE) AS i94cit,
       CAST(100 + ck % 25 AS DOUBLE) AS i94res,
       CASE WHEN k % 101 = 0 THEN NULL WHEN k % 37 = 0 THEN 'ZZZ'
            ELSE CONCAT('P', CAST(k % 25 AS VARCHAR(4))) END AS i94port,
       CAST(d AS DOUBLE) AS arrdate,
       CAST(d + CASE WHEN k % 6 = 0 THEN NULL WHEN k % 53 = 0 THEN -1 - k % 5 ELSE k % 200 END AS DOUBLE) AS depdate,
       CAST(CASE WHEN k % 97 = 1 THEN NULL WHEN k % 5 = 0 THEN 1 WHEN k % 5 = 1 THEN 2 WHEN k % 5 = 2 THEN 3
                 WHEN k % 5 = 3 THEN 9 ELSE 7 END AS DOUBLE) AS i94mode,
       CAST(CASE WHEN k % 89 = 0 THEN NULL ELSE k % 103 - 1 END AS DOUBLE) AS i94bir,
       CAST(CASE WHEN k % 89 = 0 THEN NULL ELSE 2017 - k % 103 END AS DOUBLE) AS biryear,
       CASE WHEN k % 8 = 0 THEN NULL WHEN k % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       CASE WHEN k % 71 = 0 THEN NULL WHEN seg = 'BUILDING' THEN 'B1' WHEN seg = 'FURNITURE' THEN 'B2'
            WHEN seg = 'HOUSEHOLD' THEN 'WT' WHEN seg = 'MACHINERY' THEN 'F2' ELSE 'X9' END AS visatype,
       CASE WHEN k % 5 < 3 THEN NULL WHEN k % 7 = 0 THEN 'Unknown'
            ELSE CONCAT('POST', CAST(k % 4 AS VARCHAR(4))) END AS visapost,
       CAST(CASE WHEN k % 61 = 0 THEN NULL WHEN k % 59 = 0 THEN 4 WHEN seg = 'BUILDING' THEN 1
                 WHEN seg IN ('FURNITURE', 'HOUSEHOLD') THEN 2 WHEN seg = 'MACHINERY' THEN 3
                 ELSE 5 END AS DOUBLE) AS i94visa
FROM (SELECT o_orderkey AS k, c_custkey AS ck, c_nationkey AS nk, c_mktsegment AS seg, {day} AS d
      FROM orders JOIN customer ON o_custkey = c_custkey) source
"""

LK_PORT = """
SELECT CONCAT('P', CAST(n_nationkey AS VARCHAR(4))) AS code,
       CASE WHEN n_nationkey % 7 = 0 THEN n_name WHEN n_nationkey % 11 = 0 THEN CONCAT(n_name, ', FIELD, ', r_name)
            ELSE CONCAT(n_name, ', ', r_name) END AS description
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 13
"""
LK_COUNTRY = """
SELECT CAST(100 + n_nationkey AS VARCHAR(8)) AS code, n_name AS description
FROM nation WHERE n_nationkey NOT IN (7, 17)
UNION ALL SELECT '0', 'INVALID: NONE'
"""
LK_MODE = """
SELECT '1' AS code, 'Air' AS description UNION ALL SELECT '2', 'Sea'
UNION ALL SELECT '3', 'Land' UNION ALL SELECT '9', 'Not reported'
"""


def arrivals_sql(day: str, visitor: str = "k") -> str:
    return _ARRIVALS.format(day=day, visitor=visitor)


def day(engine_day: str, late: bool) -> str:
    return f"{engine_day} + {LATE}" if late else engine_day


# Columns read from the given tables; naming them spares a look into the files.
TABLES = {
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    "customer": "c_custkey long, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def arrivals(spark: SparkSession, sf_dir: str, visitor: str = "k", late: bool = False) -> DataFrame:
    views(spark, sf_dir, "orders", "customer")
    return spark.sql(arrivals_sql(day(DAY_SPARK, late), visitor))


def lookups(spark: SparkSession, sf_dir: str) -> Lookups:
    views(spark, sf_dir, "nation", "region")
    texts = {schemas.PORT: LK_PORT, schemas.COUNTRY: LK_COUNTRY, schemas.MODE: LK_MODE}
    found = {name: unique(spark.sql(text)) for name, text in texts.items()}
    # Each port is a row of the nation table: the estimate of the join below it says nothing about its size.
    found[schemas.PORT] = sized(found[schemas.PORT], spark.table("nation"))
    return found
