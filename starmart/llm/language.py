"""Language of texts, from one bit-sliced Bloom filter over the n-grams of all languages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.llm import kernels as K
from starmart.llm import tables

#: Bytes of the n-grams. Their ends may be the edge of a word, nothing between them is.
GRAMS = (3, 4, 5)
#: Labelled rows of each language that are learned from (expected number), and n-grams kept of each language.
LEARNED_ROWS, KEPT_GRAMS = 3_000, 6_000
#: Of an n-gram's highest rate in any language, the part that makes it an n-gram of another language too.
SHARED_PART = 0.3
#: Slots of the filter per n-gram kept, and slots that each n-gram looks at.
SLOTS, PROBES = 16, 2
UNKNOWN = "und"
#: More values of `lang` than this are taken for an error; it bounds what is broadcast.
MOST_LANGUAGES = 4096

_LETTERS = set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_TABLE = K.symbol_table([b for b in range(256) if b not in _LETTERS])
_EDGE = np.uint64(0x2545F4914F6CDD1D)


def held_out() -> Column:
    """Rows that are never learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def _padded() -> Column:
    return F.concat(F.lit(" "), F.lower(F.col("text").cast("string")), F.lit(" ")).alias("text")


def _grams(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, hash of 48 bits) of all n-grams of padded lower-case texts, block by block."""
    for lo, hi, first, last in K.pieces(bounds, max(GRAMS)):
        symbols = _TABLE[data[lo:hi]]
        letter = symbols != 0
        symbols[~letter] = _EDGE
        inner = np.r_[0, np.cumsum(~letter)]
        spans = K.Spans(symbols)
        inner_bounds = np.clip(bounds, lo, hi)
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(inner_bounds))
        for n in GRAMS:
            count = hi - lo - n + 1
            if count <= 0:
                continue
            whole = (inner[n - 1 : n - 1 + count] == inner[1 : count + 1]) & (text[:count] == text[n - 1 :])
            whole[: first - lo] = False
            whole[max(0, last - lo) :] = False
            at = np.flatnonzero(whole)
            yield text[at], (spans.all(n)[at] + np.uint64(n)) >> np.uint64(16)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each language that hold an n-gram, per slice of the input."""
    for batch in (part for whole in batches for part in K.parts(whole, "text")):
        lang = batch["lang"].dictionary_encode()
        code = lang.indices.to_numpy().astype(np.int64)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64)), *_grams(*K.flat(batch["text"]))]
        text, grams = (np.concatenate(x) for x in zip(*found))
        gram, of, _ = K.distinct(grams, text)
        gram, of, counts = K.distinct(gram, code[of])
        yield pa.RecordBatch.from_arrays(
            [
                lang.dictionary.take(pa.array(of)),
                pa.array(gram.view(np.int64)),
                pa.array(counts.astype(np.int64)),
            ],
            names=["lang", "gram", "docs"],
        )


@dataclass
class Filter:
    """For each slot a mask of languages: one look answers for all languages at once."""

    languages: list[str]
    slots: np.ndarray
    #: Share of n-grams outside a language that its bits answer for all the same.
    false_rate: np.ndarray

    @classmethod
    def of(cls, languages: list[str], grams: np.ndarray, owner: np.ndarray) -> Filter:
        size = max(64, SLOTS * len(grams))
        made = cls(languages, np.zeros((size, (len(languages) + 63) // 64), np.uint64), np.zeros(len(languages)))
        for probe in range(PROBES):
            bit = np.uint64(1) << (owner % 64).astype(np.uint64)
            np.bitwise_or.at(made.slots, (made._at(grams, probe), owner // 64), bit)
        full = [made._bit(made.slots, i).mean() for i in range(len(languages))]
        made.false_rate = np.array(full) ** PROBES
        return made

    def _at(self, grams: np.ndarray, probe: int) -> np.ndarray:
        return (K.mix(grams + np.uint64((probe + 1) * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(len(self.slots))).astype(
            np.int64
        )

    @staticmethod
    def _bit(masks: np.ndarray, i: int) -> np.ndarray:
        return (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)

    def holds(self, grams: np.ndarray) -> np.ndarray:
        """The languages of each n-gram, as masks."""
        masks = self.slots[self._at(grams, 0)]
        for probe in range(1, PROBES):
            masks = masks & self.slots[self._at(grams, probe)]
        return masks

    def counts(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """N-grams of each text in each language, without the part expected by chance; and the n-grams of each text."""
        texts = len(bounds) - 1
        hits, total = np.zeros((texts, len(self.languages))), np.zeros(texts)
        for text, grams in _grams(data, bounds):
            if not len(text):
                continue
            heads = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
            total[text[heads]] += np.diff(np.append(heads, len(text)))
            masks = self.holds(grams)
            for i in range(len(self.languages)):
                hits[text[heads], i] += np.add.reduceat(self._bit(masks, i).astype(np.int32), heads)
        return np.maximum(hits - total[:, None] * self.false_rate, 0) / (1 - np.minimum(self.false_rate, 0.999)), total


def learn(docs: DataFrame) -> Filter:
    """Filter over the n-grams that mark each language, from the rows that are not held out.

    Of each language about LEARNED_ROWS labelled rows are taken, by a hash of the id, and the KEPT_GRAMS n-grams that
    most documents hold are kept, so both what is counted and what reaches the driver is bounded. Without labelled
    rows the filter knows no language.
    """
    labelled = docs.where(~F.coalesce(held_out(), F.lit(False))).select("doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("rows"))
    if len(sizes.select("lang").take(MOST_LANGUAGES + 1)) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} values of lang")
    share = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1_000_000)) * F.col("rows")
    taken = labelled.join(F.broadcast(sizes), "lang").where(share < F.lit(LEARNED_ROWS * 1_000_000))
    learned = taken.groupBy("lang").agg(F.count("*").alias("learned"))
    counted = (
        taken.select("lang", _padded())
        .mapInArrow(_counted, "lang string, gram long, docs long")
        .groupBy("lang", "gram")
        .agg(F.sum("docs").alias("docs"))
    )
    rates = counted.join(F.broadcast(learned), "lang").select("lang", "gram", (F.col("docs") / F.col("learned")).alias("rate"))
    best = rates.withColumn("most", F.max("rate").over(W.partitionBy("gram"))).where(
        (F.col("rate") >= SHARED_PART * F.col("most")) & (F.col("rate") > 0.001)
    )
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("rate"), "gram"))
    rows = best.withColumn("rank", rank).where(F.col("rank") <= KEPT_GRAMS).select("lang", "gram").collect()
    languages = sorted({r.lang for r in rows})
    index = {lang: i for i, lang in enumerate(languages)}
    return Filter.of(
        languages,
        np.array([r.gram for r in rows], np.int64).view(np.uint64),
        np.array([index[r.lang] for r in rows], np.int64),
    )


def _predict(batches: Iterator[pa.Array], known: Filter) -> Iterator[pa.Array]:
    names = np.array([*known.languages, UNKNOWN], object)
    for whole in batches:
        out = []
        for batch in K.parts(pa.RecordBatch.from_arrays([whole], names=["text"]), "text"):
            counts, total = known.counts(*K.flat(batch["text"]))
            n = batch.num_rows
            votes = np.hstack([counts, np.zeros((n, 1))])  # the last column stands for no language
            best = np.full(n, len(names) - 1)
            if known.languages:
                best = np.where(total > 0, counts.argmax(axis=1), best)
            score = votes[np.arange(n), best] / np.maximum(votes.sum(axis=1), 1e-9)
            out.append(
                pa.StructArray.from_arrays(
                    [pa.array(names[best], pa.string()), pa.array(np.clip(score, 0, 1))], names=["lang_pred", "score"]
                )
            )
        yield pa.concat_arrays(out) if out else pa.array([], pa.struct([("lang_pred", pa.string()), ("score", pa.float64())]))


def predicted(spark: SparkSession, model: Filter) -> Column:
    """lang_pred and score of `text`, as a struct. Only the texts go to Python; the other columns stay where they are.

    An n-gram counts for all languages whose bits it finds set; from the counts go the hits expected by chance. The
    language with the most is predicted, `score` is its part of all. Texts that are null or have no letters are `und`
    with score 0; so is any text if no language was learned. Ties go to the first language in order of names.
    """
    sent = spark.sparkContext.broadcast((model.languages, model.slots, model.false_rate))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _predict(batches, Filter(*sent.value))

    found = F.arrow_udf(run, "lang_pred string, score double")(_padded())
    # the n-grams take every byte from 0x80 up for a letter; whether a text has one at all is decided on the whole text
    lettered = F.coalesce(F.col("text").cast("string").rlike("\\p{L}"), F.lit(False))
    return F.when(lettered, found).otherwise(F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")))


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, learned from the same documents. Rows without id are no held-out rows."""
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        predicted(docs.sparkSession, learn(docs)).alias("found"),
    )
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def known_language(docs: DataFrame, least: float = 0.0) -> DataFrame:
    """The documents, as they came, without those whose language is unknown or scores below `least`."""
    own = tables.free(docs, "_language")
    found = docs.withColumn(own, predicted(docs.sparkSession, learn(docs)))
    kept = found.where((F.col(f"{own}.lang_pred") != UNKNOWN) & (F.col(f"{own}.score") >= least))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
