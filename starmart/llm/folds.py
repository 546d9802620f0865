"""Folds over the elements of one array, as expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def within(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once, however often it is named there."""
    return F.transform(F.array(value), use)[0]


def scan(
    values: Column, zero: Column, onward: Callable[[Column, Column], Column], shown: Callable[[Column, Column], Column], kind: str
) -> Column:
    """An array as long as `values`: `shown(state, value)` where `onward(state, value)` leads from state to state, from `zero`.

    `kind` is the type of what is shown. A list that grows inside a fold is copied with each element; here elements
    are listed in blocks as long as there are blocks, so n elements take n ** 1.5 copies and not n ** 2.
    """
    none = F.array().cast(f"array<{kind}>")

    def one(state: Column, value: Column) -> Column:
        listed = F.concat(state["list"], F.array(shown(state["at"], value)))
        return F.struct(onward(state["at"], value).alias("at"), listed.alias("list"))

    def blocks(whole: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(whole))).cast("int")

        def block(state: Column, begin: Column) -> Column:
            inner = F.aggregate(F.slice(whole, begin, size), F.struct(state["at"].alias("at"), none.alias("list")), one)
            return within(
                inner, lambda i: F.struct(i["at"].alias("at"), F.concat(state["lists"], F.array(i["list"])).alias("lists"))
            )

        start = F.struct(zero.alias("at"), F.array().cast(f"array<array<{kind}>>").alias("lists"))
        listed = F.aggregate(F.sequence(F.lit(1), F.size(whole), size), start, block, lambda s: F.flatten(s["lists"]))
        return F.when(F.size(whole) > 0, listed).otherwise(none)

    return within(values, blocks)
