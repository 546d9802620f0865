"""Ranked lexical search: documents of an item grouped by the mask of its terms that they hold."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.llm import tables

#: Documents returned for each item.
BEST = 10
#: Characters of item text, about, that one pass over the documents serves: bounds what is sent to the tasks.
PASS_CHARS = 4_000_000
#: Documents that share a set of bitmaps, and bytes of text that are split at a time.
BLOCK_DOCS, PIECE = 16_384, 1 << 20

# Terms are runs of 0-9, A-Z (as a-z), a-z and all that is not ASCII.
_KEPT = {*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)}
_TO_TERMS = bytes(b if b in _KEPT else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def _terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, a piece at a time."""
    data = (text or "").encode().translate(_TO_TERMS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


@dataclass
class Questions:
    """Items of one pass: for each, its terms (by number) and how often it repeats them."""

    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]

    @classmethod
    def of(cls, texts: list[str | None]) -> Questions:
        counts = [Counter(t for piece in _terms(text) for t in piece) for text in texts]
        vocabulary = {t: i for i, t in enumerate(sorted({t for c in counts for t in c}))}
        return cls(
            vocabulary,
            [np.array([vocabulary[t] for t in c], np.int64) for c in counts],
            [np.array(list(c.values()), np.int64) for c in counts],
        )


def _counted(vocabulary):
    """Documents with a term at all: their number of terms, and the counts of those in the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            kept, sizes, found, times, ends = [], [], [], [], [0]
            for i, text in enumerate(batch["text"]):
                n, counts = 0, Counter()
                for words in _terms(text.as_py()):
                    n += len(words)
                    counts.update(words)
                if not n:
                    continue
                own = [(known[t], k) for t, k in counts.items() if t in known]
                found += [t for t, _ in own]
                times += [k for _, k in own]
                kept.append(i)
                sizes.append(n)
                ends.append(len(found))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(kept, pa.int64())),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(at, pa.array(found, pa.int32())),
                    pa.ListArray.from_arrays(at, pa.array(times, pa.int64())),
                ],
                names=["doc_id", "size", "terms", "times"],
            )

    return run


class Block:
    """Some documents: which terms each holds, as a bitmap per term, and what each occurrence adds to a score."""

    def __init__(self, sizes: np.ndarray, ends: np.ndarray, terms: np.ndarray, times: np.ndarray, count: int, total: int):
        docs = len(sizes)
        of = np.repeat(np.arange(docs), np.diff(ends))
        length = 25 + (75 * sizes * count) // total  # 100 - 75 + ...
        self.docs, self.ends, self.terms = docs, ends, terms
        self.adds = (1_000_000_000 * times) // (1000 * times + 8 * length[of])
        self.present, place = np.unique(terms, return_inverse=True)
        self.most = np.zeros(len(self.present), np.int64)
        np.maximum.at(self.most, place, self.adds)
        self.bitmaps = np.zeros((len(self.present), (docs + 7) // 8), np.uint8)
        np.bitwise_or.at(self.bitmaps, (place, of >> 3), (0x80 >> (of & 7)).astype(np.uint8))

    def groups(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents by the mask of these terms that they hold: a number of the mask for each, and the distinct masks."""
        held = np.unpackbits(self.bitmaps[rows], axis=1, count=self.docs)
        packed = np.packbits(held, axis=0)
        words = np.zeros((self.docs, -(-len(packed) // 8) * 8), np.uint8)
        words[:, : len(packed)] = packed.T
        words = words.view(np.uint64)
        _, example, group = np.unique(words[:, 0], return_index=True, return_inverse=True)
        for word in words.T[1:]:
            _, other = np.unique(word, return_inverse=True)
            _, example, group = np.unique(group * (other.max() + 1) + other, return_index=True, return_inverse=True)
        return group, held[:, example].T

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores; `weights` by number of the term."""
        out = np.zeros(len(docs), np.int64)
        for i in range(0, len(docs), 4096):
            own = docs[i : i + 4096]
            lengths = self.ends[own + 1] - self.ends[own]
            heads = np.cumsum(lengths) - lengths
            at = np.arange(int(lengths.sum())) + np.repeat(self.ends[own] - heads, lengths)
            sums = np.r_[0, np.cumsum(weights[self.terms[at]] * self.adds[at])]
            out[i : i + 4096] = sums[heads + lengths] - sums[heads]
        return out

    def best(self, weights: np.ndarray, terms: np.ndarray, order: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents with the highest scores above 0, equal ones by `order`.

        Masks come by falling highest possible score. They are finished once the next could not reach the last place.
        """
        place = np.minimum(np.searchsorted(self.present, terms), max(len(self.present) - 1, 0))
        terms = terms[self.present[place] == terms] if len(self.present) else terms[:0]
        rows = np.searchsorted(self.present, terms)
        if not len(rows):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        group, masks = self.groups(rows)
        bound = masks @ (weights[terms] * self.most[rows])
        by_bound = np.argsort(-bound, kind="stable")
        rank = np.empty(len(bound), np.int64)
        rank[by_bound] = np.arange(len(bound))
        members = np.argsort(rank[group], kind="stable")
        ends = np.cumsum(np.bincount(rank[group], minlength=len(bound)))
        docs, scores, done, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 4 * most
        while done < len(bound) and bound[by_bound[done]] > 0:
            if len(docs) == most and bound[by_bound[done]] < scores[-1]:
                break
            lo = ends[done - 1] if done else 0
            upto = max(done + 1, int(np.searchsorted(ends, lo + step)))
            fresh = members[lo : ends[min(upto, len(bound)) - 1]]
            docs, scores = np.r_[docs, fresh], np.r_[scores, self.scores(fresh, weights)]
            keep = np.lexsort((order[docs], -scores))[:most]
            keep = keep[scores[keep] > 0]
            docs, scores, done, step = docs[keep], scores[keep], upto, 2 * step
        return docs, scores


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK_DOCS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _ranked(sent, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, repeats, weight, count, total = sent.value
        for table in _blocks(batches):
            column = {c: table[c].chunk(0) for c in table.column_names}
            ends = column["terms"].offsets.to_numpy().astype(np.int64)
            block = Block(
                column["size"].to_numpy(), ends - ends[0], column["terms"].flatten().to_numpy().astype(np.int64),
                column["times"].flatten().to_numpy(), count, total,
            )
            ids = column["doc_id"]
            order = np.empty(block.docs, np.int64)
            order[pa.compute.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(block.docs)
            items, found, scores = ([np.zeros(0, kind)] for kind in (np.int32, np.int64, np.int64))
            weights = np.zeros(len(weight), np.int64)
            for i, (own, times) in enumerate(zip(terms, repeats)):
                weights[own] = weight[own] * times
                docs, values = block.best(weights, own, order, most)
                weights[own] = 0
                items.append(np.full(len(docs), i, np.int32))
                found.append(docs)
                scores.append(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(items)), ids.take(pa.array(np.concatenate(found))), pa.array(np.concatenate(scores))],
                names=["item", "doc_id", "score"],
            )

    return run


def _once(docs: DataFrame, items: DataFrame, best: int) -> DataFrame:
    """The search for items that are few enough to be sent to every task."""
    spark = docs.sparkSession
    asked = items.collect()
    questions = Questions.of([r.text for r in asked])
    counts = tables.written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
            _counted(spark.sparkContext.broadcast(questions.vocabulary)),
            "doc_id long, size long, terms array<int>, times array<long>",
        ),
        "terms",
    )
    count, total = counts.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    weight = np.zeros(len(questions.vocabulary), np.int64)
    for r in counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("docs")).collect():
        weight[r.term] = math.floor(1000 * math.log((2 * count + 2) / (2 * r.docs + 1)))
    sent = spark.sparkContext.broadcast((questions.terms, questions.repeats, weight, count, total))
    found = counts.mapInArrow(_ranked(sent, best), "item int, doc_id long, score long")
    first = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= best)
    named = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(asked)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
    return ranked.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the `best` documents of each item with the highest scores above 0.

    Terms are runs of ASCII letters (A-Z as a-z), digits and non-ASCII characters of whole texts. A term weighs
    floor(1000 * ln((2N + 2) / (2 df + 1))); an occurrence count tf in a document of n terms adds, for each time that the
    item repeats the term, weight * (10^9 tf div (1000 tf + 8 (25 + 75 n N div L))), with N documents that have terms
    and L terms in them. Equal scores go by doc_id, rows without id last.

    Each task works on blocks of documents. A block has a bitmap per term; those of an item's terms, turned, are the
    masks of matched terms, by which the documents are grouped. The groups are scored by falling highest possible score
    until the next cannot reach the last place. Only the best of each block are shuffled, by item.

    Null and empty texts have no terms and are never found; items without terms find nothing. Long texts are split
    piece by piece. Every row is a document of its own, also if its id or text repeats. Equal rows of items count once;
    rows with one item_id but different texts are ranked apart, each from 1. Empty tables give no rows. Other columns
    are not looked at. Items are served in passes of about PASS_CHARS characters, so what is sent stays bounded.
    """
    asked = items.select("item_id", F.col("text").cast("string").alias("text")).distinct()
    chars = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = 1 + int(chars) // PASS_CHARS
    own = F.pmod(F.xxhash64(F.col("item_id").cast("string"), F.col("text")), F.lit(passes))
    return reduce(DataFrame.union, [_once(docs, asked.where(own == i), best) for i in range(passes)])
