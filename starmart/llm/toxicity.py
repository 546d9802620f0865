"""Toxicity of texts: boosted trees over a dozen dense features, calibrated by isotonic regression."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm import kernels as K
from starmart.llm import tables
from starmart.llm.language import held_out

#: Labelled rows that are learned from (expected number, by a hash of the id); a third of them calibrate.
LEARNED_ROWS = 24_000
#: Words and stems of the learned lexicon at most, labelled documents that a word has to be in, and how sure its excess has to be.
LEXICON, LEAST_DOCS, LEAST_Z = 400, 6, 6.0
#: Bytes of the stems: a longer word also counts by its beginning. 0 stands for whole words.
STEMS = (0, 5, 6, 7, 8)
TREES, DEPTH, SEED = 20, 4, 17
#: Words on either side of a lexicon word in which a second person counts as near.
NEAR = 6
THRESHOLD = 0.3
# Words for the second person in the languages of the corpus.
SECOND_PERSON = (
    "you your yours yourself u ur tu te ti tus tuyo usted ustedes vosotros toi ton ta tes vous votre vos "
    "du dich dir dein deine deiner ihr euch euer sie"
).split()
# Signs that stand for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
FEATURES = (
    "log_words", "lexicon_rate", "weighted_rate", "lexicon_count", "strongest", "near_rate", "second_rate",
    "stem_rate", "stem_weighted_rate", "stem_count", "strongest_stem",
    "capital_rate", "exclamation_rate", "punctuation_rate", "digit_rate", "obfuscated_rate", "obfuscated_count",
)

_CAPITALS = set(range(0x41, 0x5B))
_SEPARATORS = [b for b in (*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)) if b not in _CAPITALS]
_PLAIN = K.symbol_table(_SEPARATORS, lower=True)


def _unmasked() -> np.ndarray:
    table = _PLAIN.copy()
    for sign, letter in LOOKALIKES.items():
        table[ord(sign)] = table[ord(letter)]
    return table


def _codes(data: np.ndarray, bounds: np.ndarray) -> tuple[K.Words, list[tuple[int, np.ndarray, np.ndarray]]]:
    """The words, and per length of stem the words that are longer, with a number for the stem."""
    words = K.words(data, bounds, _PLAIN)
    spans, out = K.Spans(_PLAIN[data]), []
    for n in STEMS:
        at = np.flatnonzero(words.end - words.start > n)
        start = words.start[at]
        out.append((n, at, (K.mix(spans.of(start, start + n) + np.uint64(n)) if n else words.hashes[at]) >> np.uint64(16)))
    return words, out


def _hashes(words: list[str]) -> np.ndarray:
    """The numbers, of 48 bits, of single words."""
    data = [w.encode() for w in words]
    bounds = np.r_[0, np.cumsum([len(w) for w in data])].astype(np.int64)
    return K.words(np.frombuffer(b"".join(data), np.uint8), bounds, _PLAIN).hashes >> np.uint64(16)


@dataclass
class Lexicon:
    """Sorted numbers of words and stems, and their weights."""

    codes: np.ndarray
    weights: np.ndarray


def _weights(hashes: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    if not len(lexicon.codes):
        return np.zeros(len(hashes))
    at = np.minimum(np.searchsorted(lexicon.codes, hashes), len(lexicon.codes) - 1)
    return np.where(lexicon.codes[at] == hashes, lexicon.weights[at], 0.0)


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.r_[0.0, np.cumsum(values, dtype=np.float64)]
    return sums[bounds[1:]] - sums[bounds[:-1]]


def measure(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """The FEATURES of each text, row by row. Texts without words have zeros."""
    data, bounds = K.flat(texts)
    words, codes = _codes(data, bounds)
    n = np.diff(words.bounds).astype(float)
    weight, stem = np.zeros(len(words.hashes)), np.zeros(len(words.hashes))
    for length, rows, hashes in codes:
        into = stem if length else weight
        into[rows] = np.maximum(into[rows], _weights(hashes, lexicon))
    hit = weight > 0
    you = np.isin(words.hashes >> np.uint64(16), _hashes(SECOND_PERSON))
    text = np.repeat(np.arange(len(n)), np.diff(words.bounds))
    at = np.flatnonzero(hit)
    sums = np.r_[0, np.cumsum(you)]
    from_ = np.maximum(at - NEAR, words.bounds[text[at]])
    to = np.minimum(at + NEAR + 1, words.bounds[text[at] + 1])
    near = np.bincount(text[at], weights=sums[to] > sums[from_], minlength=len(n))
    strongest, strongest_stem = np.zeros(len(n)), np.zeros(len(n))
    np.maximum.at(strongest, text, weight)
    np.maximum.at(strongest_stem, text, stem)
    masked = K.words(data, bounds, _unmasked())
    shown = _per_text(hit, words.bounds)
    hidden = np.maximum(_per_text(_weights(masked.hashes >> np.uint64(16), lexicon) > 0, masked.bounds) - shown, 0)
    size = np.maximum(np.diff(bounds), 1)
    capital = _per_text((data >= 0x41) & (data <= 0x5A), bounds)
    letters = capital + _per_text(((data >= 0x61) & (data <= 0x7A)) | (data >= 0xC0), bounds)
    sign = (data > 0x20) & (data < 0x7F) & ~((data >= 0x30) & (data <= 0x39)) & (_PLAIN[data] == 0)
    many = np.maximum(n, 1)
    return np.column_stack(
        [
            np.log1p(n),
            shown / many,
            _per_text(weight, words.bounds) / many,
            shown,
            strongest,
            near / many,
            _per_text(you, words.bounds) / many,
            _per_text(stem > 0, words.bounds) / many,
            _per_text(stem, words.bounds) / many,
            _per_text(stem > 0, words.bounds),
            strongest_stem,
            capital / np.maximum(letters, 1),
            _per_text(data == 0x21, bounds) / size,
            _per_text(sign, bounds) / size,
            _per_text((data >= 0x30) & (data <= 0x39), bounds) / size,
            hidden / many,
            hidden,
        ]
    )


def _measured(lexicon: Lexicon) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in K.parts(whole, "text")):
            found = measure(batch["text"], lexicon)
            of = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.ListArray.from_arrays(of, pa.array(found.reshape(-1)))], names=["row", "features"]
            )

    return run


def features(docs: DataFrame, lexicon: Lexicon, row: Column) -> DataFrame:
    picked = docs.select(row.alias("row"), F.col("text").cast("string").alias("text"))
    kind = picked.schema["row"].dataType.simpleString()
    return picked.mapInArrow(_measured(lexicon), f"row {kind}, features array<double>")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents, and toxic ones, that hold a word or stem, per slice of the input."""
    for batch in (part for whole in batches for part in K.parts(whole, "text")):
        words, codes = _codes(*K.flat(batch["text"]))
        text = np.repeat(np.arange(batch.num_rows), np.diff(words.bounds))
        code, of, _ = K.distinct(np.concatenate([c for _, _, c in codes]), np.concatenate([text[at] for _, at, _ in codes]))
        toxic = batch["toxic"].to_numpy()[of]
        code, first, docs = np.unique(code, return_index=True, return_counts=True)
        hits = np.add.reduceat(toxic, first) if len(first) else toxic
        yield pa.RecordBatch.from_arrays(
            [pa.array(code.view(np.int64)), pa.array(hits), pa.array(docs.astype(np.int64))], names=["code", "hits", "docs"]
        )


def learn_lexicon(taken: DataFrame) -> Lexicon:
    """Words and stems that more of the toxic documents hold than chance explains, weighed by the smoothed log ratio."""
    sums = taken.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("rows")).first()
    toxic, rows = sums.toxic or 0, sums.rows or 0
    if not 0 < toxic < rows:
        return Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    share = toxic / rows
    excess = (F.col("hits") - share * F.col("docs")) / F.sqrt(share * (1 - share) * F.col("docs"))
    ratio = F.log((F.col("hits") + 0.5) / (toxic + 1)) - F.log((F.col("docs") - F.col("hits") + 0.5) / (rows - toxic + 1))
    found = (
        taken.select("text", F.col("toxic").cast("long").alias("toxic"))
        .mapInArrow(_counted, "code long, hits long, docs long")
        .groupBy("code")
        .agg(F.sum("hits").alias("hits"), F.sum("docs").alias("docs"))
        .where((F.col("docs") >= LEAST_DOCS) & (excess >= LEAST_Z) & (ratio > 0))
        .select("code", ratio.alias("weight"), excess.alias("z"))
        .orderBy(F.desc("z"), "code")
        .limit(LEXICON)
        .collect()
    )
    codes = np.array([r.code for r in found], np.int64).view(np.uint64)
    order = np.argsort(codes)
    return Lexicon(codes[order], np.array([r.weight for r in found], float)[order])


@dataclass
class Model:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    scale: IsotonicRegressionModel | None
    base: float


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Model from labelled documents that are not held out.

    LEARNED_ROWS labels (about) are taken by a hash of the id and sent to the documents, which stay where they are.
    A document of several labels counts as toxic if one says so. With labels of one kind only, or none, every
    score is that kind's share.
    """
    one = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    rows = one.count()
    part = F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1_000_000))
    sample = one.where(part * max(rows, 1) < LEARNED_ROWS * 1_000_000)
    texts = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    taken = tables.written(
        texts.join(F.broadcast(sample), "doc_id").withColumn("fit", F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0), "labelled"
    )
    lexicon = learn_lexicon(taken.where("fit"))
    measured = tables.written(
        features(taken, lexicon, F.struct("toxic", "fit")).select(
            F.col("row.toxic").cast("double").alias("label"), "row.fit", "features"
        ),
        "measured",
    ).withColumn("features", array_to_vector("features"))
    kinds = {r.label: r["count"] for r in measured.groupBy("label").count().collect()}
    total = sum(kinds.values())
    base = kinds.get(1.0, 0) / total if total else 0.0
    fit, rest = measured.where("fit"), measured.where("NOT fit")
    if any(part.select("label").distinct().count() < 2 for part in (fit, rest)):
        return Model(lexicon, None, None, base)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, stepSize=0.2, minInstancesPerNode=10).fit(fit)
    scale = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score").fit(_margin(trees, rest))
    return Model(lexicon, trees, scale, base)


def _margin(trees: GBTClassificationModel, measured: DataFrame) -> DataFrame:
    return trees.transform(measured).withColumn("margin", vector_to_array("rawPrediction")[1])


def scores(docs: DataFrame, model: Model, row: Column) -> DataFrame:
    """row, score (0 to 1) of every row. Null and empty texts have features too: all are zero."""
    measured = features(docs, model.lexicon, row)
    if model.trees is None or model.scale is None:
        return measured.select("row", F.lit(float(model.base)).alias("score"))
    margins = _margin(model.trees, measured.withColumn("features", array_to_vector("features")))
    return model.scale.transform(margins).select("row", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")).alias("score"))


def rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row. Rows without id are no held-out rows."""
    row = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(), F.lit(False)).alias("held_out"))
    found = scores(docs, learn(docs, labels), row)
    return found.select("row.doc_id", "row.held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
