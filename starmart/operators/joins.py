"""Joins with code lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.functions.codes import code_of, is_missing

# Largest estimated side that is sent to every executor.
BROADCAST_BYTES = 32 * 1024 * 1024
# Codes of each lookup that count as hot, for each shuffle partition. No other code has more than one part in
# HOT_PARTS * partitions of the rows, an eighth of an even share. It bounds the rows of a large lookup that are sent.
HOT_PARTS = 8
# Codes with fewer rows are no burden to a task, whatever their share.
HOT_ROWS = 10_000


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate: file sizes carried through the plan. Runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def sized(side: DataFrame, bound: DataFrame | None = None) -> DataFrame:
    """`side` with a broadcast hint if its estimate allows it.

    `bound` is a frame that `side` cannot outgrow, measured in its place. Without the hint Spark shuffles both
    sides, and adaptive execution splits the partitions of hot keys.
    """
    return F.broadcast(side) if estimated_bytes(side if bound is None else bound) <= BROADCAST_BYTES else side


def is_small(side: DataFrame) -> bool:
    """Whether a lookup goes to every executor: it was hinted (see `sized`), or its estimate or real size allows it.

    Estimates are upper bounds, often far off for rows that come from a join or from the driver; only where the
    estimate is too large, one pass over the lookup adds up its texts.
    """
    if "strategy=broadcast" in side._jdf.queryExecution().analyzed().toString() or estimated_bytes(side) <= BROADCAST_BYTES:
        return True
    texts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in side.columns]
    return (side.agg(F.sum(sum(texts, F.lit(64)))).first()[0] or 0) <= BROADCAST_BYTES


def attach(df: DataFrame, code: str, lookup: DataFrame, into: str) -> DataFrame:
    """Left join of one lookup: see `attach_all`."""
    return attach_all(df, [(code, lookup, into)])


def attach_all(df: DataFrame, wanted: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Left joins of lookups on normalised codes: (code column, lookup, column to add).

    Adds `into`, the description, and `into_known`, whether the code is in the lookup at all. Lookups have one
    row per code, so the number of rows stays. Small lookups are broadcast. Larger ones are joined together: see
    `_attach_large`.
    """
    large = []
    for code, lookup, into in wanted:
        side = _side(lookup, into)
        if not is_small(side):
            large.append((code, lookup, into))
            continue
        joined = df.join(F.broadcast(side), code_of(df, code) == F.col(_key(into)), "left")
        df = joined.withColumn(f"{into}_known", F.col(_key(into)).isNotNull()).drop(_key(into))
    return _attach_large(df, large) if large else df


def _key(into: str) -> str:
    return f"_{into}_key"


def _side(lookup: DataFrame, into: str) -> DataFrame:
    return lookup.select(F.col("code").alias(_key(into)), F.col("description").alias(into))


def _attach_large(df: DataFrame, wanted: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Lookups too large to be sent: their hot codes are sent, the rest meets them by shuffle.

    One pass over the code columns counts the codes, by partial aggregation. The most frequent ones, a bounded number,
    are looked up first and sent to every task with what was found. Rows whose codes are all hot or missing are then
    done: they never take part in a shuffle. The others are shuffled once per lookup, where no code is frequent any
    more; a row that is done for one lookup and not for another is dealt out by its content there, not by its code.
    However many lookups are large, the rows are read twice besides the count. A stream cannot be counted beforehand:
    its hot codes go through the shuffle.
    """
    columns = df.columns
    keys = {into: code_of(df, code) for code, _, into in wanted}
    keyed = df.withColumns({_key(into): key for into, key in keys.items()})
    hot = {} if df.isStreaming else hot_codes(keyed, [_key(into) for _, _, into in wanted])
    for _, lookup, into in wanted:
        found = _side(lookup, into).withColumn("_known", F.lit(True))
        codes = hot.get(_key(into), [])
        if not codes:
            keyed = keyed.withColumns({into: F.lit(None).cast("string"), f"{into}_known": F.lit(None).cast("boolean")})
            continue
        listed = df.sparkSession.createDataFrame([(c,) for c in codes], f"{_key(into)} string")
        sent = listed.join(found.join(F.broadcast(listed), _key(into), "left_semi"), _key(into), "left")
        keyed = keyed.join(
            F.broadcast(sent.select(_key(into), F.col(into), F.coalesce("_known", F.lit(False)).alias(f"{into}_known"))), _key(into), "left"
        )
    done = {into: F.col(_key(into)).isNull() | F.col(f"{into}_known").isNotNull() for _, _, into in wanted}
    settled = reduce(and_, done.values())
    rest = keyed if df.isStreaming else keyed.where(~settled)
    content = F.xxhash64(*[F.col(f"`{c}`") for c in columns]).cast("string")
    for _, lookup, into in wanted:
        far = _side(lookup, "_far").select(F.concat(F.lit("="), _key("_far")).alias("_far_place"), "_far")
        # a row that is done has a place that no code has
        place = F.when(done[into], F.concat(F.lit("~"), content)).otherwise(F.concat(F.lit("="), _key(into)))
        rest = (
            rest.withColumn("_place", place)
            .join(far, F.col("_place") == F.col("_far_place"), "left")
            .withColumn(into, F.coalesce(into, "_far"))
            .withColumn(f"{into}_known", F.coalesce(f"{into}_known", F.col("_far_place").isNotNull()))
            .drop("_place", "_far_place", "_far")
        )
    if not df.isStreaming:
        unknown = {f"{into}_known": F.coalesce(f"{into}_known", F.lit(False)) for _, _, into in wanted}
        rest = keyed.where(settled).withColumns(unknown).unionByName(rest)
    added = [name for _, _, into in wanted for name in (into, f"{into}_known")]
    return rest.select(*[F.col(f"`{c}`") for c in columns], *added)


def hot_codes(df: DataFrame, keys: Sequence[str]) -> dict[str, list[str]]:
    """The most frequent codes of each column, HOT_PARTS for each shuffle partition, that have HOT_ROWS rows."""
    most = HOT_PARTS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = F.array(*[F.struct(F.lit(key).alias("key"), F.col(key).alias("code")) for key in keys])
    counts = df.select(F.inline(pairs)).where("code is not null").groupBy("key", "code").agg(F.count(F.lit(1)).alias("rows"))
    rank = F.row_number().over(W.partitionBy("key").orderBy(F.desc("rows"), "code"))
    hot: dict[str, list[str]] = {key: [] for key in keys}
    for row in counts.withColumn("rank", rank).where((F.col("rank") <= most) & (F.col("rows") >= HOT_ROWS)).collect():
        hot[row.key].append(row.code)
    return hot


def described(name: Column, known: Column, otherwise: Column) -> Column:
    """Description of a known code, else a stand-in."""
    return F.when(known, name).otherwise(otherwise)


def unmapped(df: DataFrame, code: str, lookup: DataFrame) -> DataFrame:
    """Rows whose code is present but not in the lookup."""
    present, side = df.where(~is_missing(df, code)), lookup.select(F.col("code").alias("_known"))
    if is_small(side):
        return present.join(F.broadcast(side), code_of(df, code) == F.col("_known"), "left_anti")
    hit = attach(present, code, lookup, "_found")
    return hit.where("NOT _found_known").drop("_found", "_found_known")
