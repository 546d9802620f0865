"""Placement of documents on shards through a lookup table that the shards fill by turns."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slots of the table: a prime, well over a hundred times the number of shards. It bounds what is broadcast.
SLOTS = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16)


def _prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> list[int]:
    """The shard (by position) of each slot.

    A shard prefers the slots start, start + step, start + 2 step ... modulo the prime number of slots, which is an
    order of all of them. By turns, each shard claims the first slot in its order that is free. So shards differ by
    one slot at most, and a shard that comes or goes moves few slots besides its own.
    """
    if not _prime(slots):
        raise ValueError("the number of slots has to be prime")
    if not 0 < len(set(shards)) == len(shards) <= slots:
        raise ValueError("shards have to be distinct, at least one and at most as many as slots")
    place = [_number(f"start:{name}") % slots for name in shards]
    step = [_number(f"step:{name}") % (slots - 1) + 1 for name in shards]
    table, free = [-1] * slots, slots
    while True:
        for i in range(len(shards)):
            while table[place[i]] >= 0:
                place[i] = (place[i] + step[i]) % slots
            table[place[i]] = i
            free -= 1
            if not free:
                return table


def placed(docs: DataFrame, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """The rows with `slot` and `shard` added (columns of these names are replaced).

    The slot is a hash of the doc_id modulo the number of slots, so all rows of one doc_id share a shard whatever else
    is in the table; rows without doc_id go to slot 0. No row is moved: the table, SLOTS rows, is broadcast.
    """
    spark = docs.sparkSession
    rows = [(slot, shards[i]) for slot, i in enumerate(lookup_table(shards, slots))]
    table = spark.createDataFrame(rows, "slot long, shard string")
    digest = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 13), 16, 10).cast("long")
    keyed = docs.drop("slot", "shard").withColumn("slot", F.coalesce(F.pmod(digest, F.lit(slots)), F.lit(0)).cast("long"))
    return keyed.join(F.broadcast(table), "slot").select(*keyed.columns, "shard")
