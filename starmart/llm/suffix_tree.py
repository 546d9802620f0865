"""Passages of words that documents share, by winnowing: no suffix tree is built."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.repeats import Shape, without_repeats

#: Words that make a passage, and words of the prefix by which suffixes meet.
PASSAGE, PREFIX = 13, 4


def without_repeated_passages(docs: DataFrame, passage: int = PASSAGE, prefix: int = PREFIX) -> DataFrame:
    """doc_id, n_words, n_removed, starts, ends (removed spans, in words), kept (bytes: words joined by one space).

    Words are runs without white space. Each passage chooses its least gram of `prefix` words as anchor; the texts around
    anchors meet by hash, and passages are compared by hash where these differ (see `repeats`). Of each repeat, the
    document with the smallest id keeps its words. Null texts have no words; see `repeats.without_repeats` for ids and equal rows.
    """
    return without_repeats(docs, Shape(passage, prefix, True)).withColumnRenamed("n_symbols", "n_words")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
