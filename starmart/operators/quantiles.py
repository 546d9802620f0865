"""Exact quantiles without gathering or sorting the values."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parts into which a range is cut each time. It bounds what one pass returns, not what it reads.
PARTS = 1024


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> DataFrame:
    """One row q0, q1, …: the quantile of each share, interpolated between neighbours. See `quantile_values`."""
    found = quantile_values(df, [column], shares)[0]
    return df.sparkSession.createDataFrame([tuple(found)], ", ".join(f"q{i} double" for i in range(len(shares))))


def quantile_values(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> list[list[float | None]]:
    """The quantiles of each column, null where it has no value.

    Every share needs the values of two ranks. The range that holds a rank is cut into parts, the rows of each part
    are counted by partial aggregation, and the part that holds the rank is cut again, down to a single value. Each
    pass shuffles a few counts per task, whatever the number of rows or of different values, and serves all columns
    and ranks; doubles take seven passes at the most, ages or day numbers one or two.
    """
    values = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    whole = values.agg(*[_extent(F.col(f"v{i}")).alias(f"v{i}") for i in range(len(columns))]).first()

    found: dict[tuple[int, int], float] = {}
    # column and rank -> the range that holds it, and the rows before that range
    open_ranks: dict[tuple[int, int], tuple[float, float, int]] = {}
    ranks = [[(w.rows - 1) * float(share) for share in shares] if w.rows else [] for w in whole]
    for i, w in enumerate(whole):
        for rank in {at for r in ranks[i] for at in (math.floor(r), math.ceil(r))}:
            if rank < w.below:
                found[i, rank] = -math.inf
            elif rank >= w.rows - w.above:
                found[i, rank] = math.inf
            else:
                open_ranks[i, rank] = (w.low, w.high, w.below)
    while open_ranks:
        for key, (low, high, _) in list(open_ranks.items()):
            if low == high:
                found[key] = low
                del open_ranks[key]
        if open_ranks:
            counted = _counted(values, sorted({(i, low, high) for (i, _), (low, high, _) in open_ranks.items()}))
            for (i, rank), (low, high, before) in open_ranks.items():
                for part in counted[i, low, high]:
                    if rank < before + part.rows:
                        open_ranks[i, rank] = (part.low, part.high, before)
                        break
                    before += part.rows
    between = lambda i, r: _between(found[i, math.floor(r)], found[i, math.ceil(r)], r - math.floor(r))
    return [[between(i, r) for r in own] or [None] * len(shares) for i, own in enumerate(ranks)]


def _extent(value: Column) -> Column:
    finite = F.when(F.abs(value) != math.inf, value)
    return F.struct(
        F.count(value).alias("rows"),
        F.count_if(value == -math.inf).alias("below"),
        F.count_if(value == math.inf).alias("above"),
        F.min(finite).alias("low"),
        F.max(finite).alias("high"),
    )


def _between(one: float, other: float, share: float) -> float:
    return one if one == other else one + (other - one) * share


def _counted(values: DataFrame, ranges: list[tuple[int, float, float]]) -> dict[tuple[int, float, float], list]:
    """Rows, smallest and largest value of each part of each range (column, from, to), in order."""
    keys = []
    for i, (column, low, high) in enumerate(ranges):
        value = F.col(f"v{column}")
        inside = F.struct(F.lit(i).alias("range"), _part(value, low, high).alias("part"), value.alias("v"))
        keys.append(F.when(value.between(low, high) & (F.abs(value) != math.inf), inside))
    counts = (
        values.select(F.inline(F.array_compact(F.array(*keys))))
        .groupBy("range", "part")
        .agg(F.count("*").alias("rows"), F.min("v").alias("low"), F.max("v").alias("high"))
        .collect()
    )
    parts: dict[tuple[int, float, float], list] = {key: [] for key in ranges}
    for row in sorted(counts, key=lambda r: r.part):
        parts[ranges[row.range]].append(row)
    return parts


def _part(value: Column, low: float, high: float) -> Column:
    """Number of the part a value lies in; halves keep the widest ranges finite."""
    width = high - low
    if math.isinf(width):
        share = (value / 2 - low / 2) / (high / 2 - low / 2)
    elif width < 1e-300:  # too narrow to divide: apart from the smallest value, which leaves fewer each time
        return F.when(value == low, 0).otherwise(1)
    else:
        share = (value - low) / width
    return F.least(F.floor(share * PARTS), F.lit(PARTS - 1)).cast("int")
