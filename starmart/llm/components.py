"""Connected components of links, by hooking and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm import tables


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in links (a, b): the least id that it reaches.

    Each round, every node points to its least neighbour and on to where that one points; links then connect what was
    pointed to. Stars, however many links their middle has, take two or three rounds, chains a number that grows with
    the logarithm of their length. Counts per node are taken before rows are shuffled, and every round reads tables.
    """
    with tables.passing(links.sparkSession):
        return tables.written(_components(links), "components", stays=True)


def _components(links: DataFrame) -> DataFrame:
    links = tables.written(links.where("a <> b").select("a", "b").distinct(), "links")
    labels = None
    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = tables.written(
            both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("to")), "near"
        )
        onward = near.select(F.col("id").alias("to"), F.col("to").alias("onward"))
        roots = tables.written(
            near.join(onward, "to").select("id", F.col("onward").alias("root")), "roots"
        )
        if labels is None:
            labels = roots.select("id", F.col("root").alias("component"))
        else:
            step = roots.select(F.col("id").alias("component"), "root")
            labels = tables.written(
                labels.join(step, "component", "left").select("id", F.coalesce("root", "component").alias("component")),
                "labels",
            )
        a = roots.select(F.col("id").alias("a"), F.col("root").alias("ra"))
        b = roots.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        links = tables.written(
            links.join(a, "a").join(b, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(),
            "links",
        )
    if labels is None:
        return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return labels
