"""Benchmark passages inside documents, found by winnowed fingerprints and confirmed window by window."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.llm import kernels as K
from starmart.llm import tables

#: Words of a window, and of the grams of which each window keeps the least as its fingerprint.
WINDOW, GRAM = 13, 5
#: A document is contaminated if so many hundredths of its words lie in benchmark windows.
PERCENT = 5
#: Up to so many fingerprints of the benchmark (8 bytes each) are sent to every task; more are joined by shuffle.
SENT_FINGERPRINTS = 1_000_000

_LETTERS_A_TO_Z = set(range(0x41, 0x5B))
_SEPARATORS = [b for b in (*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)) if b not in _LETTERS_A_TO_Z]
_TABLE = K.symbol_table(_SEPARATORS, lower=True)


def _gram(window: int) -> int:
    """Short items are windows of their own length, with shorter grams."""
    return GRAM if window == WINDOW else max(1, (window + 1) // 2)


def _prints(words: K.Words, bounds: np.ndarray, window: int):
    """Fingerprints of texts: (text, start, window hash, fingerprint) of every window, by winnowing."""
    found = K.anchors(words.hashes, bounds, window, _gram(window))
    starts, hashes = K.windows(words.hashes, found.first, found.last, window)
    sizes = found.last - found.first + 1
    salt = np.uint64(window)
    return np.repeat(found.text, sizes), starts, K.mix(hashes + salt), np.repeat(K.mix(found.key + salt), sizes)


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = K.words(*K.flat(batch["text"]), _TABLE)
        lengths = np.minimum(np.diff(words.bounds), WINDOW)
        for window in np.unique(lengths[lengths > 0]):
            rows = np.flatnonzero(lengths == window)
            own = K.ranges(words.bounds[rows], words.bounds[rows + 1])
            bounds = np.r_[0, np.cumsum(words.bounds[rows + 1] - words.bounds[rows])]
            text, _, hashes, prints = _prints(
                K.Words(words.hashes[own], words.start[own], words.end[own], bounds), bounds, int(window)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch["item_id"].take(pa.array(rows[text])),
                    pa.array(np.full(len(text), window, np.int32)),
                    pa.array(hashes.view(np.int64)),
                    pa.array(prints.view(np.int64)),
                ],
                names=["item_id", "length", "hash", "print"],
            )


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Windows of the items: item_id, length, hash, print. Items of fewer words are one window; items of none have none."""
    return benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(_item_windows, "item_id string, length int, hash long, print long")


def _lists(of: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(of.astype(np.int32)), pa.array(values))


def _marked(lengths: list[int], known) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per document, its number of words and the windows to compare: with `known` prints only, or all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in K.parts(whole, "text")):
            words = K.words(*K.flat(batch["text"]), _TABLE)
            n = batch.num_rows
            found = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int32),)]
            for window in lengths:
                text, starts, hashes, prints = _prints(words, words.bounds, window)
                if known is not None:
                    at = np.minimum(np.searchsorted(known.value, prints), len(known.value) - 1)
                    keep = np.flatnonzero(known.value[at] == prints)
                    text, starts, hashes, prints = (x[keep] for x in (text, starts, hashes, prints))
                found.append((text, starts - words.bounds[text], hashes, prints, np.full(len(text), window, np.int32)))
            text, starts, hashes, prints, length = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(text, kind="stable")
            of = np.searchsorted(text[order], np.arange(n + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["row"],
                    pa.array(np.diff(words.bounds)),
                    _lists(of, starts[order]),
                    _lists(of, length[order]),
                    _lists(of, hashes[order].view(np.int64)),
                    _lists(of, prints[order].view(np.int64)),
                ],
                names=["doc_id", "row", "n_words", "starts", "lengths", "hashes", "prints"],
            )

    return run


def row_key() -> Column:
    """Tells rows apart by id and text; equal rows share it."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row: doc_id, row (see `row_key`), n_words, n_hit, items, contaminated.

    Words are runs of letters, digits and non-ASCII characters, A-Z as a-z. A window is WINDOW words of an item, or all
    of a shorter item. A document word is hit if it lies in an occurrence of a window. Each window, on either side,
    keeps the least of its grams as its fingerprint, so equal windows always meet; their full hashes are then compared.
    Null texts have no words. Items without id count for hits, not among `items`. An empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    items = tables.written(item_windows(benchmark), "items")
    lengths = sorted(r.length for r in items.select("length").distinct().collect())  # 13 at most
    prints = items.select("print").distinct()
    few = prints.limit(SENT_FINGERPRINTS + 1).count() <= SENT_FINGERPRINTS
    known = None
    if few and lengths:
        sent = np.fromiter((r.print for r in prints.toLocalIterator()), np.int64).view(np.uint64)
        known = spark.sparkContext.broadcast(np.sort(sent))
    marked = tables.written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row_key().alias("row")
        ).mapInArrow(
            _marked(lengths, known),
            "doc_id long, row long, n_words long, starts array<long>, lengths array<int>, hashes array<long>, prints array<long>",
        ),
        "marked",
    )
    windows = marked.select("row", F.explode(F.arrays_zip("starts", "lengths", "hashes", "prints")).alias("w")).select(
        "row", F.col("w.starts").alias("start"), F.col("w.lengths").alias("length"), F.col("w.hashes").alias("hash"),
        F.col("w.prints").alias("print"),
    )
    if known is None:
        windows = windows.join(prints, "print", "left_semi")
    # a phrase of many items is one fingerprint and many rows: what is sent is counted in rows
    sent_rows = items.limit(SENT_FINGERPRINTS + 1).count()
    hint = F.broadcast if sent_rows <= SENT_FINGERPRINTS else (lambda df: df)
    same = ["length", "hash"]
    hits = windows.join(hint(items.select(*same).distinct()), same, "left_semi")
    before = W.partitionBy("row").orderBy("start", "length").rowsBetween(W.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    spans = hits.select("row", "start", "length").distinct()
    n_hit = (
        spans.withColumn("from", F.greatest("start", F.coalesce(F.max(end).over(before), F.lit(0))))
        .groupBy("row")
        .agg(F.sum(F.greatest(end - F.col("from"), F.lit(0))).alias("n_hit"))
    )
    found = (
        hits.select("row", *same)
        .distinct()
        .join(hint(items.where("item_id IS NOT NULL").select("item_id", *same).distinct()), same)
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    hit = F.coalesce("n_hit", F.lit(0))
    return (
        marked.select("doc_id", "row", "n_words")
        .join(n_hit.join(found, "row", "left"), "row", "left")
        .select(
            "doc_id",
            "row",
            "n_words",
            hit.alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((hit > 0) & (100 * hit >= PERCENT * F.col("n_words"))).alias("contaminated"),
        )
    )


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, as they came."""
    own = tables.free(docs, "_row")
    with tables.passing(docs.sparkSession):
        hit = contamination(docs, benchmark).where("contaminated").select(F.col("row").alias(own)).distinct()
        hit = tables.written(hit, "contaminated", stays=True)
    return docs.join(hit, row_key() == F.col(own), "left_anti")
