"""Checks by name: the Spark query, and the SQL text that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures
from checks.oracle import PREFIX
from starmart.operators import rules
from starmart.operators.enrich import enrich
from starmart.plans import etl


class Data:
    """What the checks read, built from the given tables on first use. Everything is lazy: no job runs here."""

    def __init__(self, spark: SparkSession, sf_dir: str, visitor: str = "k", late: bool = False):
        self.spark, self.sf_dir, self.visitor, self.late = spark, sf_dir, visitor, late

    @cached_property
    def arrivals(self) -> DataFrame:
        return fixtures.arrivals(self.spark, self.sf_dir, self.visitor, self.late)

    @cached_property
    def lookups(self) -> dict[str, DataFrame]:
        return fixtures.lookups(self.spark, self.sf_dir)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich(self.arrivals, self.lookups)

    @cached_property
    def rules(self) -> list[rules.Rule]:
        return rules.default_rules(self.enriched)

    @cached_property
    def flagged(self) -> DataFrame:
        return rules.flag(self.enriched, self.rules)

    @cached_property
    def checked(self) -> DataFrame:
        return rules.repair(self.flagged, self.rules)

    @cached_property
    def clean(self) -> DataFrame:
        return rules.split(self.flagged, self.rules)[0]

    @cached_property
    def rejected(self) -> DataFrame:
        return rules.split(self.flagged, self.rules)[1]

    @cached_property
    def star(self) -> dict[str, DataFrame]:
        return etl.star(self.clean, self.lookups)


@lru_cache(maxsize=8)
def data(spark: SparkSession, sf_dir: str, visitor: str, late: bool = False) -> Data:
    """Checks of one session share the plans, not the rows: nothing is cached in Spark."""
    return Data(spark, sf_dir, visitor, late)


@dataclass(frozen=True)
class Check:
    run: Callable[[Data], DataFrame]
    sql: str | None
    visitor: str
    late: bool = False


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None, visitor: str = "k", late: bool = False) -> Callable:
    """Register a check. `visitor` is the key used as visitor id: 'ck' gives visitors with many arrivals.

    With `late`, many arrivals lie beyond the usual days of a date table.
    """

    def register(run: Callable[[Data], DataFrame]) -> Callable:
        if name in CHECKS:
            raise ValueError(f"check {name} is registered twice")
        CHECKS[name] = Check(run, sql, visitor, late)
        return run

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(item: Check) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: item.run(data(spark, sf_dir, item.visitor, item.late))

    return {name: bound(item) for name, item in CHECKS.items()}


def oracle_sql() -> dict[str, str]:
    return {
        name: PREFIX.format(visitor=item.visitor, day=fixtures.day(fixtures.DAY_DUCK, item.late)) + item.sql
        for name, item in CHECKS.items() if item.sql is not None
    }


def texts(df: DataFrame, *columns: str) -> DataFrame:
    """Dates as text, so that both engines show them alike."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Fractions to a fixed number of digits, since engines differ in the last bits."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
