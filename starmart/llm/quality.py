"""Quality rules whose cutoffs are chosen so that they reject few good documents, provably so on a labelled holdout."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.llm import tables

#: Of the good documents of a stratum, the part that all rules together may reject, and the chance that they reject more.
RISK, DOUBT = 0.01, 0.05
#: Up to so many strata are broadcast with their cutoffs; more are joined by shuffle.
SENT_STRATA = 10_000
LEAST_WORDS, MOST_REPEATED = 50, 50


@dataclass(frozen=True)
class Rule:
    """Rejects where `metric` exceeds a cutoff. Cutoffs go from lenient to strict; they don't depend on the data."""

    name: str
    metric: Callable[[], Column]
    cutoffs: tuple[float, ...]


def _per(part: str, whole: str) -> Callable[[], Column]:
    return lambda: F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)


RULES = (
    Rule("symbols", _per("n_symbols", "n_words"), (4.0, 3.0, 2.0, 1.5, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1, 0.05)),
    Rule("repeated_words", _per("n_repeat_words", "n_words"), (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05)),
    Rule("repeated_lines", _per("n_dup_lines", "n_lines"), (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1)),
    Rule("long_words", _per("word_chars", "n_words"), (40.0, 30.0, 20.0, 15.0, 12.0, 10.0, 9.0)),
    Rule("capitals", _per("n_capitals", "word_chars"), (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
)


def counts(docs: DataFrame) -> DataFrame:
    """doc_id, stratum (the language) and the counts of every text, worked out row by row without a shuffle.

    Three-word windows are told apart by 64-bit hashes cut by the bits that number the windows of their text; sorting
    them brings equal ones together. The steps are separate selects so that each array is made once.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    split = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum"),
        text.alias("text"),
        F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "").alias("words"),
    )
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    counted = split.select(
        "doc_id",
        "stratum",
        "words",
        F.size("words").alias("n"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long").alias("n_capitals"),
        lines.alias("lines"),
    )
    known = ["doc_id", "stratum", "n", "word_chars", "n_symbols", "n_capitals"]
    word = F.col("words")
    numbered = counted.select(
        *known,
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "words",
        F.when(F.col("n") >= 3, F.sequence(F.lit(0), F.col("n") - 3)).otherwise(F.array().cast("array<int>")).alias("at"),
        # one more than the largest number of a window, to the next power of two
        F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n") + 1.0))).cast("long").alias("room"),
    )
    known += ["n_lines", "n_dup_lines"]
    hashed = numbered.select(
        *known,
        (F.col("room") - 1).alias("mask"),
        F.sort_array(
            F.transform("at", lambda i: F.xxhash64(word[i], word[i + 1], word[i + 2]).bitwiseAND(-F.col("room")) + i)
        ).alias("sorted"),
    )
    one = F.slice("sorted", 1, F.greatest(F.size("sorted") - 1, F.lit(0)))
    other = F.slice("sorted", 2, F.greatest(F.size("sorted") - 1, F.lit(0)))
    mask = F.col("mask")
    same = F.zip_with(
        one, other, lambda a, b: F.when(a.bitwiseXOR(b) <= mask, F.when(a.bitwiseXOR(b) >= 0, F.array(a.bitwiseAND(mask), b.bitwiseAND(mask))))
    )
    repeated = hashed.select(*known, F.flatten(F.filter(same, lambda x: x.isNotNull())).alias("repeated"))
    covered = F.array_distinct(F.flatten(F.transform("repeated", lambda i: F.sequence(i, i + 2))))
    return repeated.select(
        "doc_id",
        "stratum",
        F.col("n").cast("long").alias("n_words"),
        *known[3:],
        F.size(covered).cast("long").alias("n_repeat_words"),
    ).withColumn(
        "base_failed",
        (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
    )


def chance_of_so_few(hits: Column, trials: Column, rate: float) -> Column:
    """P(X <= hits) for a binomial X. Hits beyond the mean give 1: they never speak for a lower rate."""
    log_odds = F.lit(rate / (1 - rate))
    n = trials.cast("double")
    first = n * F.log(F.lit(1 - rate))

    def onward(state: Column, i: Column) -> Column:
        log = state["log"] + F.log((n - i + 1) / i) + F.log(log_odds)
        return F.struct(log.alias("log"), (state["sum"] + F.exp(log)).alias("sum"))

    whole = F.aggregate(
        F.when(hits > 0, F.sequence(F.lit(1), hits.cast("int"))).otherwise(F.array().cast("array<int>")),
        F.struct(first.alias("log"), F.exp(first).alias("sum")),
        onward,
        lambda s: s["sum"],
    )
    return F.when(hits > n * rate, F.lit(1.0)).otherwise(whole)


def path() -> list[dict[str, float]]:
    """Joint settings of all rules, from lenient to strict: each step takes the next cutoff of every rule that has one."""
    return [
        {rule.name: float(rule.cutoffs[min(step, len(rule.cutoffs) - 1)]) for rule in RULES}
        for step in range(max(len(rule.cutoffs) for rule in RULES))
    ]


def cutoffs(counted: DataFrame, labels: DataFrame, risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """stratum, rule, cutoff: the strictest joint setting of all rules that the labelled good documents allow.

    For a stratum, a setting is safe if so few of its n good labelled documents are rejected by any rule as happens with
    at most `doubt` / strata chance where the true rate is `risk`. Settings are tested along one `path` fixed beforehand,
    up to the first that is not safe, so its steps need no further correction; nor do the rules, which are tested as one.
    With the chance 1 - `doubt`, no stratum then loses more than `risk` of its good documents. Strata with few labels get
    no cutoff: without any hit, ln(`doubt` / strata) / ln(1 - `risk`) good documents are needed.
    """
    good = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
        .where("quality = 1")
        .select("doc_id")
    )
    held = counted.where("NOT base_failed").join(good, "doc_id", "left_semi")
    settings = path()
    hit = [reduce(Column.__or__, [rule.metric() > setting[rule.name] for rule in RULES]) for setting in settings]
    sums = held.groupBy("stratum").agg(
        F.count("*").alias("good"), F.array(*[F.count_if(h) for h in hit]).alias("hits")
    )
    sums = tables.written(sums.select("stratum", "good", F.posexplode("hits").alias("step", "hits")), "holdout")
    strata = max(sums.select("stratum").distinct().count(), 1)
    safe = chance_of_so_few(F.col("hits"), F.col("good"), risk) <= doubt / strata
    upto = W.partitionBy("stratum").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    last = sums.withColumn("safe", F.min(safe).over(upto)).where("safe").groupBy("stratum").agg(F.max("step").alias("step"))
    of = F.array(
        *[
            F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(cut).alias("cutoff")) for name, cut in setting.items()])
            for setting in settings
        ]
    )
    return last.select("stratum", F.inline(of[F.col("step")]))


def judged(docs: DataFrame, labels: DataFrame, risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """Per row: doc_id, the counts, base_failed, rejected_by (names of rules), kept.

    Words are runs without white space; null texts have none. A row is kept if it passes the base and no rule of its
    stratum rejects it. Rows with no language are a stratum of their own; rows without id are judged, but are no part
    of the holdout. With empty labels only the base rejects.
    """
    counted = tables.written(counts(docs), "counted")
    chosen = tables.written(
        cutoffs(counted, labels, risk, doubt)
        .groupBy("stratum")
        .agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")),
        "cutoffs",
    )
    few = len(chosen.select("stratum").take(SENT_STRATA + 1)) <= SENT_STRATA
    joined = counted.join(F.broadcast(chosen) if few else chosen, "stratum", "left")
    verdicts = [F.when(rule.metric() > F.col("cutoffs")[rule.name], F.lit(rule.name)) for rule in RULES]
    rejected = F.array_compact(F.array(*verdicts))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        rejected.alias("rejected_by"),
        (~F.col("base_failed") & (F.size(rejected) == 0)).alias("kept"),
    )
