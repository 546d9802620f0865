"""Folders written from the given tables and read back: lookup files, and the whole job."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import Data, check
from starmart import schemas, session
from starmart.plans import etl, reports
from starmart.sources import lookups, runs


def folder(d: Data) -> str:
    """A new folder in the shared one; without one, on this machine, if all of Spark runs here."""
    if d.spark.conf.get("spark.checkpoint.dir", None) is None and not d.spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = session.shared_folder(d.spark, "") or tempfile.mkdtemp(prefix="starmart-")
    return f"{root.rstrip('/')}/check-{uuid.uuid4().hex}"


def long_table(d: Data) -> DataFrame:
    parts = [table.select(F.lit(name).alias("lookup"), "code", "description") for name, table in d.lookups.items()]
    return reduce(DataFrame.unionByName, parts)


_LOOKUPS = """
SELECT 'i94prtl' AS lookup, code, description FROM lk_port UNION ALL SELECT 'i94cntyl', code, description FROM lk_country
UNION ALL SELECT 'i94model', code, description FROM lk_mode
"""


@check("s2_lookup_folder", _LOOKUPS)
def _(d):
    path = folder(d)
    lookups.write_csv(long_table(d), path)
    return lookups.read_csv_dir(d.spark, path)


@check("s3_named_lookup", "SELECT code, description FROM lk_country")
def _(d):
    path = folder(d)
    lookups.write_csv(long_table(d), path)
    return lookups.read_named(d.spark, path, [schemas.COUNTRY])[schemas.COUNTRY]


@check(
    "s10_round_trip",
    """
SELECT 'r' || n_regionkey AS lookup, 'K' || n_nationkey AS code, n_name || ', "' || r_name || '" ' || n_nationkey || ',' AS description
FROM nation JOIN region ON n_regionkey = r_regionkey
""",
)
def _(d):
    """Commas, quotes and blanks within texts, out to CSV and back."""
    nation, region = (d.spark.read.parquet(f"{d.sf_dir}/{name}.parquet") for name in ("nation", "region"))
    text = F.format_string('%s, "%s" %s,', "n_name", "r_name", "n_nationkey")
    rows = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("r"), "n_regionkey").alias("lookup"), F.concat(F.lit("K"), "n_nationkey").alias("code"), text.alias("description")
    )
    path = folder(d)
    lookups.write_csv(rows, path)
    return lookups.read_csv_dir(d.spark, path)


@check("s14_rows", "SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS description FROM nation")
def _(d):
    """The rows of a small table, at hand in the driver, as a lookup."""
    rows = d.spark.read.parquet(f"{d.sf_dir}/nation.parquet").collect()
    return lookups.from_rows(d.spark, [(str(r.n_nationkey), r.n_name) for r in rows])


@lru_cache(maxsize=2)
def job(d: Data) -> tuple[str, str]:
    """The whole job over arrivals and lookups laid down as files: where its tables are."""
    root = folder(d)
    d.arrivals.write.parquet(f"{root}/in")
    lookups.write_csv(long_table(d), f"{root}/staging")
    etl.run(d.spark, f"{root}/in", f"{root}/staging", f"{root}/out", f"{root}/rejected")
    return f"{root}/out", f"{root}/rejected"


# Table, its rows, and the sum of one column.
_SUMS = (
    (schemas.FACT, "fact", "arrival_date_id"),
    (schemas.DIM_DATE, "dim_date", "date_id"),
    (schemas.DIM_VISITOR, "dim_visitor", "visitor_id"),
    (schemas.DIM_VISA, "dim_visa_by_code", "length(visa_code)"),
    (schemas.DIM_PORT, "dim_port", "length(port_of_entry)"),
)


@check(
    "b6_job_tables",
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS rows, CAST(sum({value}) AS BIGINT) AS total FROM {view}" for name, view, value in _SUMS
    )
    + f" UNION ALL SELECT '{schemas.REJECTED}', count(*), CAST(sum(length(rejection_reason)) AS BIGINT) FROM rejected"
    + f" UNION ALL SELECT '{schemas.SUMMARY}', count(DISTINCT rejection_reason), count(*) FROM rejected",
)
def _(d):
    output, rejected = job(d)
    tables = reports.load(d.spark, output)
    tables |= {name: d.spark.read.parquet(f"{rejected}/{name}") for name in (schemas.REJECTED, schemas.SUMMARY)}
    sums = {name: value for name, _, value in _SUMS} | {schemas.REJECTED: "length(rejection_reason)", schemas.SUMMARY: "Count"}
    counted = [
        tables[name].agg(F.count(F.lit(1)).alias("rows"), F.sum(F.expr(value)).cast("long").alias("total")).select(F.lit(name).alias("name"), "*")
        for name, value in sums.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@check(
    "a18_ledger",
    """
SELECT 'raw' AS name, count(*) AS rows FROM judged UNION ALL SELECT 'judged', count(*) FROM judged
UNION ALL SELECT 'clean', count(*) FROM clean UNION ALL SELECT 'rejected', count(*) FROM rejected
UNION ALL SELECT 'summarised', count(*) FROM rejected UNION ALL SELECT 'counted_rejected', count(*) FROM rejected
""",
)
def _(d):
    """The counts that had to agree before the job's tables were published."""
    ledger = runs.manifest(d.spark, job(d)[0])["ledger"]
    return d.spark.createDataFrame(list(ledger.items()), "name string, rows long")
