"""Validation rules, the split into clean and rejected rows, quarantine, counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.codes import is_missing, to_number
from starmart.operators.enrich import HIT_COLUMNS, VISA_MISSING
from starmart.sources.arrivals import ORIGIN, SOURCE_FILE, SOURCE_ROW

ORIGINAL = "original_record"


@dataclass(frozen=True, eq=False)
class Rule:
    """A condition that rejects a row.

    `needs` are the columns the condition reads: without them the rule is skipped, and reported as skipped.
    `nullify` are columns to blank on rows that break the rule. With `min_share` the rule takes effect only when
    at least that share of all rows breaks it.
    """

    name: str
    reason: str
    condition: Column
    needs: tuple[str, ...] = ()
    nullify: tuple[str, ...] = ()
    min_share: float | None = None

    @property
    def flag(self) -> str:
        return f"rule_{self.name}"


def default_rules(df: DataFrame) -> list[Rule]:
    """The five rules in evaluation order, for a frame `enrich` made."""

    def unknown_code(code: str, known: str) -> Column:
        present = ~is_missing(df, code) if code in df.columns else F.lit(False)
        return present & ~F.col(known)

    negative_age = to_number(F.col("i94bir")) < 0 if "i94bir" in df.columns else F.lit(False)
    # The reason texts, and the order of the rules.
    return [
        Rule(
            "port",
            "Invalid port code",
            unknown_code("i94port", "port_name_known"),
            ("i94port", "port_name_known"),
            ("i94port",),
        ),
        Rule(
            "dates",
            "Departure date before arrival date",
            F.col("depdate_dt") < F.col("arrdate_dt"),
            ("arrdate_dt", "depdate_dt"),
            ("departure_date_id",),
        ),
        Rule("age", "Negative age value", negative_age, ("i94bir",), ("i94bir",)),
        Rule(
            "citizenship",
            "Unknown country citizenship code",
            unknown_code("i94cit", "citizenship_name_known"),
            ("i94cit", "citizenship_name_known"),
        ),
        Rule(
            "residence",
            "Unknown country residence code",
            unknown_code("i94res", "residence_name_known"),
            ("i94res", "residence_name_known"),
        ),
    ]


def active(df: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """Rules whose columns are there; looks at the schema only."""
    present = set(df.columns)
    return [rule for rule in rules if set(rule.needs) <= present]


def applied(flagged: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """Rules that left a flag in the frame."""
    present = set(flagged.columns)
    return [rule for rule in rules if rule.flag in present]


def keep_original(df: DataFrame) -> DataFrame:
    """The row as it came, in one struct. Comes before anything that changes a column."""
    return df.withColumn(ORIGINAL, F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in ORIGIN]))


def flag(df: DataFrame, rules: Sequence[Rule], defer: bool = False) -> DataFrame:
    """One boolean per rule, then `is_rejected` and `rejection_reason`.

    Of several broken rules the last in the list gives the reason. Flags read the columns as they came in:
    blanking happens in `repair`, so the order of the rules never changes who is rejected. A rule with `min_share`
    needs a pass over all rows first; with `defer` it counts as if it had none, until `decide` is told its share.
    """
    live = active(df, rules)
    flags = {rule.flag: F.coalesce(rule.condition, F.lit(False)) if defer else _holds(df, rule) for rule in live}
    return _judged(df.withColumns(flags) if flags else df, live)


def broken_counts(rules: Sequence[Rule]) -> dict[str, Column]:
    """Rows that break each rule with `min_share`, to be observed while flagged rows are written."""
    return {rule.flag: F.count_if(rule.flag) for rule in rules if rule.min_share is not None}


def decide(flagged: DataFrame, rules: Sequence[Rule], rows: int, broken: Mapping[str, int]) -> DataFrame:
    """Deferred flags, now that it is known how many rows broke each rule: those of rules below their share go."""
    live = applied(flagged, rules)
    idle = [r.flag for r in live if r.min_share is not None and rows and broken[r.flag] / rows < r.min_share]
    return _judged(flagged.withColumns({name: F.lit(False) for name in idle}), live) if idle else flagged


def _judged(flagged: DataFrame, live: Sequence[Rule]) -> DataFrame:
    broken = [F.when(F.col(rule.flag), F.lit(rule.reason)) for rule in reversed(live)]
    return flagged.withColumns(
        {
            "is_rejected": reduce(or_, [F.col(rule.flag) for rule in live], F.lit(False)),
            "rejection_reason": F.coalesce(*broken, F.lit(None).cast("string")),
        }
    )


def _holds(df: DataFrame, rule: Rule) -> Column:
    broken = F.coalesce(rule.condition, F.lit(False))
    if rule.min_share is None:
        return broken
    if df.isStreaming:
        raise ValueError(f"rule {rule.name}: min_share is a share of all rows, which a stream does not have")
    share = df.select(F.count_if(broken) / F.count(F.lit(1))).scalar()
    return broken & (share >= F.lit(rule.min_share))


def repair(flagged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Blank the columns that broken rules name."""
    columns = set(flagged.columns)
    hits: dict[str, list[Column]] = {}
    for rule in applied(flagged, rules):
        for name in rule.nullify:
            if name in columns:
                hits.setdefault(name, []).append(F.col(rule.flag))
    blanked = {name: F.when(~reduce(or_, flags), F.col(name)) for name, flags in hits.items()}
    return flagged.withColumns(blanked) if blanked else flagged


def split(flagged: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Clean rows, without any rule columns, and rejected rows with the columns blanked that broke a rule.

    A clean row breaks no rule, so there is nothing to blank on that side.
    """
    clean = flagged.where(~F.col("is_rejected")).drop("is_rejected", "rejection_reason", *_helpers(flagged))
    return clean, repair(flagged.where("is_rejected"), rules)


def _helpers(flagged: DataFrame) -> list[str]:
    return [ORIGINAL, *ORIGIN, *HIT_COLUMNS, VISA_MISSING, *[c for c in flagged.columns if c.startswith("rule_")]]


def quarantine(rejected: DataFrame) -> DataFrame:
    """Rejected rows as documented: the original record, the reason, when, from which file, and an id.

    The id is the digest of file and row number, so it is the same in every run and differs between equal rows.
    Rows that do not come from files are told apart by content only.
    """
    if SOURCE_ROW in rejected.columns:
        source, identity = F.col(SOURCE_FILE), F.concat_ws("#", SOURCE_FILE, SOURCE_ROW)
    else:
        source, identity = F.lit(None).cast("string"), F.to_json(ORIGINAL)
    return rejected.select(
        ORIGINAL,
        "is_rejected",
        "rejection_reason",
        F.current_timestamp().alias("rejection_timestamp"),
        source.alias("source_file"),
        F.sha2(identity, 256).alias("rejection_id"),
    )


def quarantine_flat(rejected: DataFrame) -> DataFrame:
    """Rejected rows with flat columns, repaired and derived ones included."""
    raw = [field.name for field in rejected.schema[ORIGINAL].dataType.fields]
    helpers = set(_helpers(rejected))
    derived = [c for c in rejected.columns if c not in raw and c not in helpers]
    present = set(rejected.columns)
    flat = [F.col(f"`{c}`") if c in present else F.col(f"{ORIGINAL}.`{c}`").alias(c) for c in raw]
    return rejected.select(*flat, *derived)


def summary(rejected: DataFrame) -> DataFrame:
    """Rejected rows per reason."""
    return rejected.groupBy(F.col("rejection_reason").alias("Rejection Reason")).agg(
        F.count(F.lit(1)).alias("Count")
    )


# Flags that are counted but reject nothing: name of the count, column.
CHECKS = (("visa_type", VISA_MISSING), ("departure", "is_overstay"))


def missing_counts(flagged: DataFrame) -> DataFrame:
    """Rows without a visa type, and without a departure, whatever the rules say. One pass, one row per check."""
    live = [(name, flag) for name, flag in CHECKS if flag in flagged.columns]
    counted = flagged.agg(*[F.count_if(flag).alias(name) for name, flag in live])
    return counted.unpivot([], [name for name, _ in live], "missing", "rows")


def rule_counts(flagged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break each rule, over all rows, whatever other rules say. One pass, one row per rule."""
    live = applied(flagged, rules)
    counted = flagged.agg(*[F.count_if(rule.flag).alias(rule.name) for rule in live])
    return counted.unpivot([], [rule.name for rule in live], "rule", "rows")


def metrics(flagged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Quality metrics (metric, item, rows): total, rejected, per reason, per rule, skipped rules, missing values.

    One pass: counts are taken per reason, and these few rows are then laid out as the table.
    """
    live = applied(flagged, rules)
    flags = {rule.flag for rule in live}
    checks = [(name, flag) for name, flag in CHECKS if flag in flagged.columns]
    counted = flagged.groupBy("rejection_reason").agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(c) for c in [*[rule.flag for rule in live], *[flag for _, flag in checks]]]
    )
    reason = F.col("rejection_reason")

    def entry(metric: str, item: Column, rows: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"), item.cast("string").alias("item"), rows.cast("bigint").alias("rows")
        )

    entries = [
        entry("total", F.lit(None), F.col("rows")),
        entry("rejected", F.lit(None), F.when(reason.isNotNull(), F.col("rows"))),
        *[entry("rule", F.lit(rule.name), F.col(rule.flag)) for rule in live],
        *[entry("missing", F.lit(name), F.col(flag)) for name, flag in checks],
        entry("reason", reason, F.when(reason.isNotNull(), F.col("rows"))),
    ]
    # Zero rows of what is always reported, so that it is there for an empty table too.
    always = [
        entry("total", F.lit(None), F.lit(0)),
        entry("rejected", F.lit(None), F.lit(0)),
        *[entry("rule" if rule.flag in flags else "skipped", F.lit(rule.name), F.lit(0)) for rule in rules],
        *[entry("missing", F.lit(name), F.lit(0)) for name, _ in checks],
    ]
    zeros = flagged.sparkSession.range(1).select(F.inline(F.array(*always)))
    return (
        counted.select(F.inline(F.array(*entries)))
        .where("rows is not null")
        .unionByName(zeros)
        .groupBy("metric", "item")
        .agg(F.sum("rows").alias("rows"))
    )


def rate_by_day(flagged: DataFrame) -> DataFrame:
    """Rejections per arrival date and reason, and their share of that day's rows; feeds monitoring over time."""
    return rates(flagged.groupBy("arrdate_dt", "rejection_reason").agg(F.count(F.lit(1)).alias("rows")))


def rates(per_reason: DataFrame) -> DataFrame:
    """The same from counts: arrdate_dt, rejection_reason (null for clean rows), rows."""
    per_day = per_reason.groupBy("arrdate_dt").agg(
        F.sum("rows").alias("total"),
        F.collect_list(F.struct("rejection_reason", "rows")).alias("reasons"),
    )
    return per_day.select("arrdate_dt", "total", F.inline("reasons")).where("rejection_reason is not null").select(
        "arrdate_dt", "rejection_reason", "rows", (F.col("rows") * 100 / F.col("total")).alias("percent")
    )
