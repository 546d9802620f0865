"""Near copies: documents whose word shingles overlap, found by one-permutation MinHash and star-shaped candidates."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm import kernels as K
from starmart.llm import tables
from starmart.llm.components import components

#: Words of a shingle, and the overlap in percent (intersection over union) that links two documents.
SHINGLE, PERCENT = 5, 85
#: Bands of so many bins. At 85 % overlap a pair shares no bucket with a chance of (1 - 0.85^5)^32, below 1e-8.
BANDS, ROWS = 32, 5
BINS = BANDS * ROWS
#: Members of a bucket that become middles in the first round after the two stars, and the factor from round to round.
MIDDLES, GROWTH = 4, 4
#: Steps of differences from a middle in which partners are looked for before pairs are made.
STEPS = 64
#: Up to so many ids of documents to compare are sent to every task that reads the corpus (8 bytes each).
SENT_IDS = 2_000_000

_TABLE = K.symbol_table(K.WHITESPACE, lower=True)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, bins binary"


def shingles(data: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted: (text, hash). Fewer words than a shingle are one shingle."""
    words = K.words(data, bounds, _TABLE)
    count = np.diff(words.bounds)
    text = np.repeat(np.arange(len(count)), np.where(count > 0, np.maximum(count - width + 1, 1), 0))
    first = K.ranges(words.bounds[:-1], words.bounds[:-1] + np.bincount(text, minlength=len(count)))
    length = np.minimum(width, count)[text]
    hashes = np.zeros(len(first), np.uint64)
    for lo in range(0, len(first), K.BLOCK):
        at, size = first[lo : lo + K.BLOCK], length[lo : lo + K.BLOCK]
        if len(at):
            own = K.Spans(words.hashes[at[0] : at[-1] + size[-1]])
            hashes[lo : lo + K.BLOCK] = own.of(at - at[0], at - at[0] + size) + size.astype(np.uint64)
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[new], hashes[new]


def bins(text: np.ndarray, hashes: np.ndarray, texts: int) -> np.ndarray:
    """One permutation: a hash falls into one bin and competes there. Empty bins take the value of a random full one.

    Each empty bin walks through bins in an order of its own, the same for all texts, to the first full one (optimal
    densification), so two texts borrow alike as far as they are alike. Texts without shingles stay empty.
    """
    bin_ = (((hashes >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)).astype(np.int64)
    value = K.mix(hashes ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(1)
    least = np.full((texts, BINS), _EMPTY)
    np.minimum.at(least.reshape(-1), text * BINS + bin_, value)
    out = least.copy()
    rows, cols = np.nonzero((least == _EMPTY) & (least != _EMPTY).any(axis=1)[:, None])
    step = 0
    while len(rows):
        step += 1
        at = (K.mix(cols.astype(np.uint64) * np.uint64(1 << 20) + np.uint64(step)) % np.uint64(BINS)).astype(np.int64)
        got = least[rows, at]
        out[rows, cols] = got
        left = got == _EMPTY
        rows, cols = rows[left], cols[left]
    return out


def fingerprints(text: np.ndarray, hashes: np.ndarray, texts: int) -> list[np.ndarray]:
    """Two sums over the shingles of each text."""
    sums = [np.zeros(texts, np.uint64), np.zeros(texts, np.uint64)]
    heads = np.flatnonzero(np.r_[True, text[1:] != text[:-1]]) if len(text) else np.zeros(0, np.int64)
    for i, seed in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
        if len(heads):
            sums[i][text[heads]] = np.add.reduceat(K.mix(hashes ^ np.uint64(seed)), heads)
    return sums


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in K.parts(whole, "text"):
            n = batch.num_rows
            data, bounds = K.flat(batch["text"])
            text, hashes = shingles(data, bounds, SHINGLE)
            count = np.bincount(text, minlength=n)
            sums = fingerprints(text, hashes, n)
            found = bins(text, hashes, n)
            keys = np.zeros((n, BANDS), np.uint64)
            for r in range(ROWS):
                keys = keys * np.uint64(0x9E3779B97F4A7C15) + found[:, r::ROWS]
            keys = K.mix(keys + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(count.astype(np.int64)),
                    *(pa.array(s.view(np.int64)) for s in sums),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1).view(np.int64))
                    ),
                    pa.array([x.tobytes() for x in found.astype(np.uint8)], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "bins"],
            )


def signatures(docs: DataFrame) -> DataFrame:
    """One row per document: size and fingerprint of its shingle set, keys of its bands, low bytes of its bins."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _sign, _SIGNED
    )


def classes(signed: DataFrame) -> DataFrame:
    """Shingle sets that occur, each with its least document. Documents without shingles are in none."""
    return signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_a", "set_b", "n_shingles").agg(
        F.min("doc_id").alias("rep")
    )


def crowded(reps: DataFrame) -> DataFrame:
    """doc_id, set_a, bucket, size: the members of each bucket that holds two shingle sets or more."""
    members = reps.select("doc_id", "set_a", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return tables.written(members.join(sizes, "bucket"), "buckets")


def middles(members: DataFrame) -> DataFrame:
    """bucket, heaviest, random: two members of each bucket, from partial aggregates.

    One is the member that meets most others over all its buckets: the origin of a family of copies meets more of them
    than the copies meet each other. The other is a random member, by a hash of the id alone: buckets that share members
    share it, and the same pair comes from all of them.
    """
    weights = members.groupBy("doc_id").agg(F.sum("size").alias("weight"))
    return tables.written(
        members.join(weights, "doc_id")
        .groupBy("bucket")
        .agg(
            F.max_by("doc_id", F.struct("weight", -F.col("doc_id"))).alias("heaviest"),
            F.min_by("doc_id", F.xxhash64("doc_id")).alias("random"),
        ),
        "middles",
    )


def candidates(members: DataFrame, stars: DataFrame) -> DataFrame:
    """Pairs (a, b) of documents to compare first: in each bucket, all members with its two middles.

    So n members of a bucket make fewer than 2n pairs, and buckets are never gathered. What the stars leave apart,
    `joined` compares.
    """
    pairs = members.join(stars, "bucket").select(
        "doc_id", F.explode(F.array_distinct(F.array("heaviest", "random"))).alias("middle")
    )
    return (
        pairs.where("doc_id <> middle")
        .select(F.least("doc_id", "middle").alias("a"), F.greatest("doc_id", "middle").alias("b"))
        .distinct()
    )


def _differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each document and middle, the shingles that one of the two has and the other has not."""
    for whole in batches:
        for batch in K.parts(whole, "text_a"):
            n = batch.num_rows
            (one, own), (other, mid) = (shingles(*K.flat(batch[c]), SHINGLE) for c in ("text_a", "text_b"))
            marks = [K.mix(fingerprints(pair, hashes, n)[0]) for pair, hashes in ((one, own), (other, mid))]
            pair, hashes = np.concatenate([one, other]), np.concatenate([own, mid])
            order = np.lexsort((hashes, pair))
            pair, hashes = pair[order], hashes[order]
            twice = np.zeros(len(pair) + 1, bool)
            twice[1:-1] = (pair[1:] == pair[:-1]) & (hashes[1:] == hashes[:-1])
            alone = ~(twice[1:] | twice[:-1])
            pair, hashes = pair[alone], hashes[alone]
            keys = K.mix(hashes + marks[1][pair])
            bounds = np.searchsorted(pair, np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"], batch["middle"], batch["component"],
                    pa.array((marks[0] + K.mix(marks[1])).view(np.int64)),
                    pa.array(np.bincount(one, minlength=n).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys.view(np.int64))),
                ],
                names=["doc_id", "middle", "component", "part", "n", "keys"],
            )


def bounds(docs: DataFrame, star: DataFrame) -> DataFrame:
    """doc_id, middle, u, v of those documents of `star` (doc_id, middle, component) that may be linked across components.

    For documents a, b with the same middle, let d be the number of shingles in which each differs from it, n the size
    of its set. Both sets differ in d(a) + d(b) - 2k shingles, k of these differences being the same for both. A link
    needs (100 + PERCENT) (2k - d(a) - d(b)) + (100 - PERCENT) (n(a) + n(b)) >= 0, and k is at most s(a) and s(b): the
    differences of each that documents of two components or more have. So a link across components needs u(a) <= v(b)
    and u(b) <= v(a), where u = (100 + PERCENT) d - (100 - PERCENT) n and v = (100 + PERCENT) (2s - d) + (100 - PERCENT) n.
    Copies of one origin that differ from it in places of their own all fall out here, one by one, not in pairs.

    Documents without any such partner go: per middle, the largest v of all whose u is small enough, by steps of u. An
    id with several texts has its least u and largest v. Equal hashes only ever raise s, which keeps more.
    """
    texts = star
    for side, name in (("doc_id", "text_a"), ("middle", "text_b")):
        texts = texts.join(docs.select(F.col("doc_id").alias(side), F.col("text").alias(name)), side)
    schema = "doc_id long, middle long, component long, part long, n long, keys array<long>"
    found = tables.written(texts.select("doc_id", "middle", "component", "text_a", "text_b").mapInArrow(_differ, schema), "differ")
    each = found.select("doc_id", "middle", "component", "part", F.explode("keys").alias("key"))
    ends = each.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    several = tables.written(ends.where("least <> most").select("key"), "several")
    row = ["doc_id", "middle", "part"]
    shared = each.join(several, "key", "left_semi").groupBy(*row).agg(F.count("*").alias("s"))
    d, s, n = F.size("keys").cast("long"), F.coalesce("s", F.lit(0)), F.col("n")
    limits = tables.written(
        found.join(shared, row, "left")
        .select("doc_id", "middle", ((100 + PERCENT) * d - (100 - PERCENT) * n).alias("u"),
                ((100 + PERCENT) * (2 * s - d) + (100 - PERCENT) * n).alias("v"))
        .groupBy("doc_id", "middle").agg(F.min("u").alias("u"), F.max("v").alias("v")),
        "limits",
    )
    span = limits.groupBy("middle").agg(F.min("u").alias("low"), (F.max("u") - F.min("u") + 1).alias("span"))
    step = lambda x: F.floor((F.col(x) - F.col("low")) * STEPS / F.col("span"))
    placed = tables.written(limits.join(span, "middle").select("*", step("u").alias("at"), step("v").alias("upto")), "placed")
    tops = placed.groupBy("middle", "at").agg(F.max("v").alias("top"))
    tops = tops.groupBy("middle").agg(F.collect_list(F.struct("at", "top")).alias("tops"))
    best = F.array_max(F.transform(F.filter("tops", lambda x: x["at"] <= F.col("upto")), lambda x: x["top"]))
    return placed.join(tops, "middle").where(best >= F.col("u")).select("doc_id", "middle", "u", "v")


def _several(members: DataFrame) -> DataFrame:
    """The rows of those buckets whose members lie in two components or more."""
    ends = members.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    return members.join(ends.where("least <> most").select("bucket"), "bucket", "left_semi")


def _apart(members: DataFrame, upto: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) across components, in each bucket of its next middles with all members; and the members left then.

    `size` and the hash of a member decide from which number of middles on it is one; at last all are. Of two members
    the one with the lesser hash compares both. Pairs that `bounds` shows not to be linked are not made.
    """
    middle = (F.col("place") < F.lit(upto * 2.0**63) / F.col("size")) | (F.col("size") <= upto)
    one, other = members.where(middle).alias("x"), members.alias("y")
    enough = (F.col("x.u") <= F.col("y.v")) & (F.col("y.u") <= F.col("x.v"))
    order = F.struct("x.place", "x.doc_id") < F.struct("y.place", "y.doc_id")
    found = one.join(
        other, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.component") != F.col("y.component")) & order & enough
    )
    return found.select(
        F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")
    ).distinct(), members.where(~middle)


def joined(docs: DataFrame, reps: DataFrame, same: DataFrame) -> DataFrame:
    """(id, component) of linked documents, and of those in `same` (a, b). Every pair that shares a bucket is compared, or is in one component anyhow.

    After the two stars, members of buckets with several components that may be linked across these (`bounds`) go on: each
    round takes GROWTH times as many middles and compares them across components only, until no bucket has two components
    among the members that have not been middles.
    """
    members = crowded(reps)
    docs = compared(docs, members)
    stars = middles(members)
    near = alike(reps, candidates(members, stars))
    found = components(confirmed(docs, near).union(same))
    left = members.join(found, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", "bucket", F.coalesce("component", "doc_id").alias("component")
    )
    left = tables.written(_several(left.distinct()), "apart")
    if left.isEmpty():
        return found
    left = tables.written(left.join(stars.select("bucket", F.col("heaviest").alias("middle")), "bucket"), "star")
    left = left.join(bounds(docs, left.select("doc_id", "middle", "component").distinct()), ["doc_id", "middle"]).drop("middle")
    # `left` goes to a table before buckets are looked at, so that hot ones can be split
    left = tables.written(_several(tables.written(left, "members")), "apart")
    sizes = left.groupBy("bucket").agg(F.count("*").alias("size"))
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)
    left = tables.written(left.join(sizes, "bucket").withColumn("place", place), "apart")
    links, upto = [found.select(F.col("id").alias("a"), F.col("component").alias("b"))], MIDDLES
    while not left.isEmpty():
        pairs, rest = _apart(left, upto)
        new = alike(reps, pairs.join(near, ["a", "b"], "left_anti"))
        if not new.isEmpty():
            near = near.union(new)
            made = tables.written(confirmed(docs, new), "made")
            links.append(made)
            of = left.select(F.col("doc_id"), "component").distinct()
            for side in ("a", "b"):
                made = made.join(of.select(F.col("doc_id").alias(side), F.col("component").alias(f"of_{side}")), side)
            step = components(made.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))
            step = step.select(F.col("id").alias("component"), F.col("component").alias("root"))
            rest = rest.join(step, "component", "left").withColumn("component", F.coalesce("root", "component")).drop("root")
            rest = tables.written(rest, "members")
        left = tables.written(_several(rest), "apart")
        upto *= GROWTH
    return components(reduce(DataFrame.union, links)) if len(links) > 1 else found


def _overlap(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray], pairs: int):
    """Sizes of intersection and union of the sets of each pair."""
    pair, hashes = (np.concatenate(x) for x in zip(one, other))
    order = np.lexsort((hashes, pair))
    pair, hashes = pair[order], hashes[order]
    twice = (pair[1:] == pair[:-1]) & (hashes[1:] == hashes[:-1])
    both = np.bincount(pair[1:][twice], minlength=pairs)
    return both, np.bincount(pair, minlength=pairs) - both


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in K.parts(whole, "text_a"):
            sets = [shingles(*K.flat(batch[c]), SHINGLE) for c in ("text_a", "text_b")]
            both, union = _overlap(*sets, batch.num_rows)
            linked = pa.array((100 * both >= PERCENT * union) & (union > 0))
            yield pa.RecordBatch.from_arrays(
                [batch[c].filter(linked) for c in ("a", "b")], names=["a", "b"]
            )


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drops pairs whose bins agree six deviations less often than those of linked documents."""
    for batch in batches:
        if not batch.num_rows:
            continue
        one, other = (
            np.frombuffer(K.flat(batch[c])[0], np.uint8).reshape(batch.num_rows, BINS) for c in ("bins_a", "bins_b")
        )
        size = np.minimum(batch["size_a"].to_numpy(), batch["size_b"].to_numpy())
        part = PERCENT / 100
        least = part - 6 * np.sqrt(part * (1 - part) / np.minimum(size, BINS))
        near = pa.array((one == other).mean(axis=1) >= least)
        yield pa.RecordBatch.from_arrays([batch[c].filter(near) for c in ("a", "b")], names=["a", "b"])


def alike(reps: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose bins agree about as often as those of linked documents, or more."""
    for side in ("a", "b"):
        pairs = pairs.join(
            reps.select(
                F.col("doc_id").alias(side), F.col("bins").alias(f"bins_{side}"), F.col("n_shingles").alias(f"size_{side}")
            ),
            side,
        )
    return tables.written(pairs.mapInArrow(_alike, "a long, b long"), "pairs")


def compared(docs: DataFrame, members: DataFrame) -> DataFrame:
    """doc_id, text of the documents that share a bucket: all that is ever compared, taken from the corpus once."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wanted = tables.written(members.select("doc_id").distinct(), "wanted")
    few = wanted.limit(SENT_IDS + 1).count() <= SENT_IDS
    return tables.written(texts.join(F.broadcast(wanted) if few else wanted, "doc_id", "left_semi"), "compared")


def confirmed(texts: DataFrame, near: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets overlap enough."""
    for side in ("a", "b"):
        near = near.join(texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}")), side)
    return near.mapInArrow(_confirm, "a long, b long")


def near_copies(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    Words are runs without white space, with A-Z as a-z. Documents with equal shingle sets are one class; classes are
    linked where their full sets overlap by PERCENT, and `component_id` is the least doc_id in reach. The document that
    bears it is kept. Null and empty texts have no shingles and are linked with nothing. Rows of one doc_id are one
    document, also where their texts differ: it is linked with what any of them is linked with. A row without doc_id has no component and is kept.
    """
    with tables.passing(docs.sparkSession):
        return tables.written(_near_copies(docs), "components", stays=True)


def _near_copies(docs: DataFrame) -> DataFrame:
    signed = tables.written(signatures(docs), "signatures")
    sets = tables.written(classes(signed), "sets")
    reps = tables.written(
        signed.join(sets.select(F.col("rep").alias("doc_id"), "set_a", "set_b"), ["doc_id", "set_a", "set_b"])
        .dropDuplicates(["doc_id", "set_a", "set_b"])
        .select("doc_id", "set_a", "n_shingles", "bands", "bins"),
        "representatives",
    )
    full = signed.where("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", "set_a", "set_b")
    one = F.struct("set_a", "set_b")
    several = full.groupBy("doc_id").agg(F.min(one).alias("least"), F.max(one).alias("most")).where("least <> most")
    same = full.join(several.select("doc_id"), "doc_id").join(sets, ["set_a", "set_b"])
    found = joined(docs, reps, tables.written(same.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")), "same"))
    reach = sets.join(found, sets["rep"] == found["id"], "left").select(
        "set_a", "set_b", F.coalesce("component", "rep").alias("reach")
    )
    return (
        signed.select("doc_id", "n_shingles", "set_a", "set_b")
        .join(tables.written(reach, "reach"), ["set_a", "set_b"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("reach", "doc_id"))
            .otherwise(F.col("doc_id"))
            .alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def without_near_copies(docs: DataFrame) -> DataFrame:
    """The documents, as they came, that near_copies keeps; of rows that share a kept id, the first by their content.

    Only ids to drop are joined to the texts. Rows without id stay.
    """
    with tables.passing(docs.sparkSession):
        dropped = near_copies(docs).where("NOT kept").select("doc_id").distinct()
        dropped = tables.written(dropped, "dropped", stays=True)
    twice = tables.written(docs.groupBy("doc_id").count().where("doc_id IS NOT NULL AND count > 1").select("doc_id"), "twice")
    kept = docs.join(dropped, "doc_id", "left_anti")
    if twice.isEmpty():
        return kept.select(*docs.columns)
    once = kept.join(twice, "doc_id", "left_semi")
    first = once.groupBy("doc_id").agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "doc_id"])).alias("first"))
    return kept.join(twice, "doc_id", "left_anti").select(*docs.columns).union(
        first.select("doc_id", "first.*").select(*docs.columns)
    )
