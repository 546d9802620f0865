"""The whole job: arrivals and lookups in, star tables, quarantine and metrics out.

The raw table is read once. The checked rows go to a staged table in the shared folder, with the original record
kept on rejected rows only; every output then reads just its columns from there. So no output repeats the rule
joins, and a lost executor costs the tasks it ran, not the chain before them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import schemas, session
from starmart.operators import dims, fact, rules
from starmart.operators.enrich import VISA_MISSING, enrich
from starmart.operators.joins import estimated_bytes
from starmart.operators.rules import Rule
from starmart.sources import arrivals, lookups, runs, sinks
from starmart.sources.lookups import Lookups

RuleSet = Callable[[DataFrame], Sequence[Rule]]

ARRIVAL_MONTH = "arrival_month"
STAR = (schemas.DIM_DATE, schemas.DIM_VISITOR, schemas.DIM_VISA, schemas.DIM_PORT, schemas.FACT)


@dataclass
class Result:
    """Rows written per table, what was left out for lack of columns or lookups, files that could not be read, and
    the counts that had to agree before the tables were published."""

    rows: dict[str, int] = field(default_factory=dict)
    skipped_rules: list[str] = field(default_factory=list)
    skipped_tables: list[str] = field(default_factory=list)
    skipped_files: list[str] = field(default_factory=list)
    ledger: dict[str, int] = field(default_factory=dict)


def check(
    raw: DataFrame, named: Lookups, rule_set: RuleSet = rules.default_rules, defer: bool = False
) -> tuple[DataFrame, Sequence[Rule]]:
    """Raw rows with everything derived and flagged, still one row each, and the rules that were asked for.

    With `defer`, rules that need a share of all rows are decided later: see `rules.flag`.
    """
    enriched = enrich(rules.keep_original(raw), named)
    checks = rule_set(enriched)
    return rules.flag(enriched, checks, defer), checks


# Columns of clean rows that the star tables read: the visitor table, and the others.
VISITOR_SOURCES = ("cicid", "i94cit", "i94res", "i94bir", "biryear", "gender")
_STAR_SOURCES = (
    *VISITOR_SOURCES,
    "i94port",
    "visatype",
    "visapost",
    "i94visa",
    "arrival_date_id",
    "departure_date_id",
    "travel_mode",
    "is_overstay",
)
# The file of each row, staged only where unreadable files are passed over.
READ_FROM = "read_from"
# Columns of rejected rows beyond those: none on clean rows, so they take no room there.
_REJECTED_ONLY = (rules.ORIGINAL, *arrivals.ORIGIN, "arrdate_dt", "depdate_dt")


def staged_columns(checked: DataFrame, checks: Sequence[Rule], with_file: bool = False) -> DataFrame:
    """What the outputs need of the checked rows, and no more; `with_file` adds the file of every row."""
    live = rules.applied(checked, checks)
    repaired = [name for rule in live for name in rule.nullify]
    wanted = dict.fromkeys([*_STAR_SOURCES, VISA_MISSING, *repaired, *[r.flag for r in live], "is_rejected", "rejection_reason"])
    rejected_only = [
        F.when(F.col("is_rejected"), F.col(name)).alias(name)
        for name in _REJECTED_ONLY
        if name in checked.columns and name not in wanted
    ]
    file = [F.col(arrivals.SOURCE_FILE).alias(READ_FROM)] if with_file else []
    return checked.select([name for name in wanted if name in checked.columns] + rejected_only + file)


def star(
    clean: DataFrame,
    named: Lookups,
    visa_full_grain: bool = False,
    date_start: str = dims.DATE_START,
    date_end: str = dims.DATE_END,
) -> dict[str, DataFrame]:
    """The star tables of clean rows; a table without its columns or lookup is left out.

    The visa table has one row per visa type, or with `visa_full_grain` one per post and class of a type. The date
    table covers the given days and every day of the facts.
    """
    columns = set(clean.columns)
    tables = {schemas.DIM_DATE: dims.date(clean.sparkSession, date_start, date_end, clean)}
    if "cicid" in columns:
        tables[schemas.DIM_VISITOR] = dims.visitor(clean, named)
    if "visatype" in columns:
        tables[schemas.DIM_VISA] = dims.visa(clean) if visa_full_grain else dims.visa_by_code(clean)
    if "i94port" in columns and schemas.PORT in named:
        tables[schemas.DIM_PORT] = dims.port(clean, named)
    tables[schemas.FACT] = fact.arrivals(clean)
    return tables


def with_month(table: DataFrame) -> DataFrame:
    """Fact rows with their arrival month as yyyymm, to lay files out by."""
    return table.withColumn(ARRIVAL_MONTH, F.expr("arrival_date_id div 100").cast("int"))


def run(
    spark: SparkSession,
    input_path: str,
    staging_path: str,
    output_path: str,
    rejected_path: str,
    fmt: str = "parquet",
    rule_set: RuleSet = rules.default_rules,
    drop_columns: Sequence[str] = (),
    by_month: bool = False,
    skip_corrupt: bool = False,
    flat_quarantine: bool = False,
    visa_full_grain: bool = False,
    date_start: str = dims.DATE_START,
    date_end: str = dims.DATE_END,
) -> Result:
    """Run the job, write all tables, and publish them together once their counts agree.

    Errors are raised, and leave the tables of the run before as they are. Files that `skip_corrupt` passes over are
    named in the result and in a table beside the rejected rows.
    """
    output, rejected_root = output_path.rstrip("/"), rejected_path.rstrip("/")
    runs.settle(spark, output)
    named = lookups.read_named(spark, staging_path)
    raw = arrivals.read(spark, input_path, drop_columns=drop_columns, origin=True, skip_corrupt=skip_corrupt)
    checked, checks = check(raw, named, rule_set, defer=True)

    result = Result()
    live = {rule.name for rule in rules.applied(checked, checks)}
    result.skipped_rules = [rule.name for rule in checks if rule.name not in live]

    run_id = uuid.uuid4().hex
    own = {root: runs.folder(root, run_id) for root in (output, rejected_root)}
    stage = f"{session.shared_folder(spark, output).rstrip('/')}/_checked_{run_id}"
    publishing = False
    try:
        rows = staged_columns(checked, checks, with_file=skip_corrupt)
        broken = rules.broken_counts(rules.applied(checked, checks))
        seen = sinks.write_observed(rows, stage, totals=broken)
        staged = rules.decide(spark.read.parquet(stage), checks, seen["rows"], seen)
        skipped = None
        if skip_corrupt:
            read = staged.groupBy(F.col(READ_FROM).alias("file")).agg(F.count(F.lit(1)).alias("read_rows"))
            skipped = arrivals.skipped(spark, [input_path], raw.schema, read)
            staged = staged.drop(READ_FROM)
        clean, rejected = rules.split(staged, checks)
        visitors = staged.select([c for c in VISITOR_SOURCES if c in staged.columns])
        outputs = star(clean, named, visa_full_grain, date_start, date_end)
        result.skipped_tables = [name for name in STAR if name not in outputs]

        places = {name: output for name in (*outputs, schemas.METRICS)}
        places |= {name: rejected_root for name in (schemas.REJECTED, schemas.SUMMARY)}
        by = {}
        if by_month and "arrival_date_id" in outputs[schemas.FACT].columns:
            outputs[schemas.FACT], by = with_month(outputs[schemas.FACT]), {schemas.FACT: ARRIVAL_MONTH}
        formats = dict.fromkeys(outputs, fmt)
        outputs[schemas.METRICS] = rules.metrics(staged, checks)
        # Both are written without rejections too, so that those of an earlier run don't stay.
        outputs[schemas.REJECTED] = rules.quarantine_flat(rejected) if flat_quarantine else rules.quarantine(rejected)
        outputs[schemas.SUMMARY] = rules.summary(rejected)
        gone = [f"{output}/{name}" for name in result.skipped_tables]
        if skipped is None:
            gone.append(f"{rejected_root}/{schemas.SKIPPED_FILES}")
        else:
            outputs[schemas.SKIPPED_FILES], places[schemas.SKIPPED_FILES] = skipped, rejected_root
        # counts within tables that have to agree with others
        measured = {name: F.sum(F.when(F.col("metric") == name, F.col("rows"))) for name in ("total", "rejected")}
        totals = {schemas.SUMMARY: {"total": F.sum("Count")}, schemas.METRICS: measured}
        writes = [
            (table, f"{own[places[name]]}/{name}", formats.get(name, "parquet"), by.get(name), totals.get(name)) for name, table in outputs.items()
        ]
        # The tables do not depend on each other: small ones fill the gaps that the last tasks of large ones leave.
        with session.sized_shuffles(spark, estimated_bytes(visitors)), ThreadPoolExecutor(len(writes)) as pool:
            counts = dict(zip(outputs, pool.map(lambda write: sinks.write_observed(*write), writes)))
        result.rows = {name: count["rows"] for name, count in counts.items()}
        result.ledger = {
            "raw": seen["rows"],
            "clean": counts[schemas.FACT]["rows"],
            "rejected": counts[schemas.REJECTED]["rows"],
            "summarised": counts[schemas.SUMMARY]["total"],
            "judged": counts[schemas.METRICS]["total"],
            "counted_rejected": counts[schemas.METRICS]["rejected"],
        }
        if skipped is not None:
            result.skipped_files = sorted(unquote(r.file) for r in skipped.select("file").collect())
        runs.balance(result.ledger)
        moves = {f"{own[places[name]]}/{name}": f"{places[name]}/{name}" for name in outputs}
        publishing = True
        runs.publish(spark, output, run_id, moves, gone, list(own.values()), result.ledger, result.rows)
    finally:
        for path in (stage, *(() if publishing else own.values())):
            session.remove(spark, path)
    return result
