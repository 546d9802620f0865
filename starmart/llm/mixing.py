"""Mixing of sources to target weights: every document is repeated by a Poisson number of its own."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm import folds, tables

#: Without given weights, a source weighs its size to this power: small sources come up more often than they would.
POWER = 0.7
SEED = 17
#: Up to so many sources are broadcast (a row is a name and some numbers); more are joined by shuffle.
SENT_SOURCES = 10_000


def uniform(seed: int, *keys: Column) -> Column:
    """A number in (0, 1) from the keys alone, the same in every run and in every engine with md5."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: Mapping[str, float] | None = None, total: float | None = None) -> DataFrame:
    """source, size (characters of its texts), rate (mean number of copies of its documents).

    The rates make the expected sizes of the sources stand to each other as their weights, and add up to `total`
    characters (as many as now, by default). A source without weight, or with none to give, has rate 0.
    """
    size = F.sum(F.coalesce(F.length(F.col("text").cast("string")), F.lit(0)).cast("double"))
    sizes = docs.groupBy(F.col("source").cast("string").alias("source")).agg(size.alias("size"))
    if weights is None:
        weight = F.when(F.col("size") > 0, F.pow("size", F.lit(POWER))).otherwise(0.0)
    else:
        given = [x for name, w in weights.items() for x in (F.lit(name), F.lit(float(w)))]
        weight = F.coalesce(F.create_map(*given)[F.col("source")], F.lit(0.0)) if given else F.lit(0.0)
    weighed = tables.written(sizes.withColumn("weight", F.when(F.col("size") > 0, weight).otherwise(0.0)), "sources")
    sums = weighed.agg(F.sum("weight").alias("weights"), F.sum("size").alias("sizes")).first()
    wanted = (sums.sizes or 0.0) if total is None else float(total)
    rate = F.when((F.col("weight") > 0), F.col("weight") / F.lit(sums.weights or 1.0) * F.lit(wanted) / F.col("size"))
    return weighed.select("source", "size", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def steps(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1) ... of a Poisson number, up to where no number below 1 lies beyond."""
    first = F.exp(-rate)
    last = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    start = F.struct((-rate).alias("log"), first.alias("sum"))

    def onward(state: Column, k: Column) -> Column:
        log = state["log"] + F.log(rate) - F.log(k.cast("double"))
        return F.struct(log.alias("log"), (state["sum"] + F.exp(log)).alias("sum"))

    later = folds.scan(F.sequence(F.lit(1), last), start, onward, lambda state, k: onward(state, k)["sum"], "double")
    return F.when(rate > 0, F.concat(F.array(first), later)).otherwise(F.array(F.lit(1.0)))


def copies(docs: DataFrame, weights: Mapping[str, float] | None = None, total: float | None = None, seed: int = SEED) -> DataFrame:
    """The rows with `copies` added: the Poisson number whose distribution function the document's hash falls into.

    The hash is of seed and doc_id, so a document keeps its place in the distribution when rates change: raising a
    rate never takes copies away. Rows of one doc_id have as many copies each. A null source is a source of its own.
    """
    own, rate, upto = (tables.free(docs, name) for name in ("_source", "_rate", "_steps"))
    of = rates(docs, weights, total).select(F.col("source").alias(own), F.col("rate").alias(rate), steps(F.col("rate")).alias(upto))
    few = len(of.select(own).take(SENT_SOURCES + 1)) <= SENT_SOURCES
    joined = docs.drop("copies").join(F.broadcast(of) if few else of, F.col("source").cast("string").eqNullSafe(F.col(own)))
    u = uniform(seed, F.col("doc_id"))
    count = F.size(F.filter(upto, lambda p: p < u)).cast("int")
    names = [c for c in docs.columns if c != "copies"]
    return joined.select(*[F.col(f"`{c}`") for c in names], F.when(F.col(rate) > 0, count).otherwise(0).alias("copies"))


def mixed(docs: DataFrame, weights: Mapping[str, float] | None = None, total: float | None = None, seed: int = SEED) -> DataFrame:
    """Every document as many times as its number says, in random order, with `copy` (0, 1 ...) added.

    Each copy draws a key of its own; rows are dealt out by that key and sorted by it within partitions, so a hot
    source is spread evenly and its copies don't lie together. Empty tables stay empty.
    """
    repeated = copies(docs, weights, total, seed).where("copies > 0")
    names = [c for c in repeated.columns if c not in ("copies", "copy")]
    key = tables.free(repeated, "_key")
    repeated = repeated.select(
        *[F.col(f"`{c}`") for c in names], F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")
    ).withColumn(key, uniform(seed + 1, F.col("doc_id"), F.col("copy")))
    return repeated.repartition(F.col(key)).sortWithinPartitions(key).drop(key)
