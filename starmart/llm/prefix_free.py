"""Passages of bytes that documents share, by winnowing: neither a dictionary nor a suffix array is built."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.repeats import Shape, without_repeats

#: Bytes that make a passage, and bytes that the rolling hash of a trigger looks at.
PASSAGE, TRIGGER = 50, 16


def without_repeated_bytes(docs: DataFrame, passage: int = PASSAGE, trigger: int = TRIGGER) -> DataFrame:
    """doc_id, n_bytes, n_removed, starts, ends (removed spans, in bytes), kept (the remaining bytes).

    Each passage chooses its least gram of `trigger` bytes as anchor, so the same text is cut into the same regions
    everywhere. Equal regions meet by hash, and the least document of one settles every passage in it. Only passages of
    regions that agree next to an anchor are compared one by one, by hash (see `repeats`). Null texts are empty; see `repeats.without_repeats` for ids and equal rows.
    """
    return without_repeats(docs, Shape(passage, trigger, False)).withColumnRenamed("n_symbols", "n_bytes")


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
