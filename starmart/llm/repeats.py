"""Passages that documents share: which windows of a document also start in a document with a smaller id.

The windows themselves are never shuffled: a text of n symbols has n of them. Each window chooses one of its grams as
its anchor, by content alone, so a passage and its copies are cut at the same places, and one row stands for all
windows that choose one anchor (10 to 20 of them). Two steps decide them:

1. *Regions.* The text that the windows of an anchor cover is its region. Equal regions hold equal windows, so the
   least document of a region settles all of them at once. Regions meet by their anchor together with the context
   next to it, so a frequent gram gathers nothing. Within a task, equal regions become one row before they
   are shuffled: a passage in a third of all documents costs one row per task.
2. *Borders.* Where a passage begins or ends, regions differ but may share windows. They then share the anchor and, on
   one side at least, the context next to it. Only windows of such regions are compared one by one, again as one row
   per task and window.

A task that sees several such regions sends them to step 2 itself and reports what they share once, so a passage with
many continuations never gathers them in one place. Hashes compared across documents have 48 bits besides those that
choose their bucket, and regions those of their anchor too; buckets grow in number with the data.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm import kernels as K
from starmart.llm import tables

#: Rows that a task takes in at once in the two comparing steps.
GROUP_ROWS = 120_000
#: Text that a task looks at in one go; equal regions in it become one row.
TASK_BYTES = 8 << 20
_U48 = np.uint64((1 << 48) - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ROW = np.dtype([("key", "<u4"), ("low", "<u4"), ("high", "<u2")])
_KEY = np.dtype([("key", "<u4")])
_UNIT = np.dtype([("low", "<u4"), ("high", "<u2")])
_REGIONS, _DONE, _BORDER, _SHARED = 0, 1, 2, 3
_PACKED = "bucket int, kind tinyint, base long, ids binary, rows binary"
_FOUND = "doc_id long, kind tinyint, unit long"


@dataclass(frozen=True)
class Shape:
    """What is compared: windows of so many symbols, anchored at grams of so many; `words` or bytes."""

    window: int
    gram: int
    words: bool


def _symbols(texts: pa.Array, shape: Shape):
    """(symbols, bounds of the texts among them, bytes, words or None)"""
    data, bounds = K.flat(texts)
    if not shape.words:
        return data, bounds, data, None
    words = K.words(data, bounds, _WORD_TABLE)
    return words.hashes, words.bounds, data, words


_WORD_TABLE = K.symbol_table(K.WHITESPACE)


def _units(found: K.Anchors) -> np.ndarray:
    """48 bits for a region with its anchor."""
    return K.mix(found.region * _ODD + found.key) & _U48


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows begin a new group."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _sizes(heads: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(heads, n))


def _often(keys: np.ndarray) -> np.ndarray:
    """Which keys stand there more than once."""
    order = np.argsort(keys)
    heads = _heads(keys[order])
    out = np.zeros(len(keys), bool)
    out[order] = np.repeat(_sizes(heads, len(keys)) > 1, _sizes(heads, len(keys)))
    return out


def _by_unit(ids: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by unit and document, and where each unit begins: with its least document."""
    order = np.lexsort((ids, units))
    ids, units = ids[order], units[order]
    return ids, units, _heads(units)


def _spread(numbers: np.ndarray, buckets: int) -> np.ndarray:
    return (K.mix(numbers.astype(np.uint64) + _ODD) % np.uint64(buckets)).astype(np.int32)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)


def _packed(kind: int, bucket: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> Iterator[tuple]:
    """One row per bucket: ids as differences, in as few bytes as they need, and the rows side by side."""
    order = np.lexsort((ids, bucket))
    bucket, ids, rows = bucket[order], ids[order], rows[order]
    heads = _heads(bucket)
    for lo, hi in zip(heads, np.append(heads[1:], len(bucket))):
        steps = np.diff(ids[lo:hi], prepend=ids[lo]).view(np.uint64)
        narrow = np.min_scalar_type(int(steps.max()))
        yield int(bucket[lo]), kind, int(ids[lo]), steps.astype(narrow).tobytes(), rows[lo:hi].tobytes()


def _unpacked(table: pa.Table, kind: int, row: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    ids, rows = [np.zeros(0, np.int64)], [np.zeros(0, row)]
    for one, base, steps, packed in zip(*(table[c].to_pylist() for c in ("kind", "base", "ids", "rows"))):
        if one == kind:
            rows.append(np.frombuffer(packed, row))
            width = len(steps) // len(rows[-1])
            ids.append(base + np.cumsum(np.frombuffer(steps, f"<u{width}").astype(np.uint64)).view(np.int64))
    return np.concatenate(ids), np.concatenate(rows)


def _batch(rows: list[tuple], fields: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "tinyint": pa.int8(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[t]) for n, t in (f.split() for f in fields.split(", "))])
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def _found(ids: np.ndarray, kind: int, units: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(np.full(len(ids), kind, np.int8)), pa.array(units.view(np.int64))],
        names=["doc_id", "kind", "unit"],
    )


def _halves(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return units & np.uint64(0xFFFFFFFF), units >> np.uint64(32)


def _as_units(units: np.ndarray) -> np.ndarray:
    rows = np.zeros(len(units), _UNIT)
    rows["low"], rows["high"] = _halves(units)
    return rows


def _from_units(rows: np.ndarray) -> np.ndarray:
    return rows["low"].astype(np.uint64) | (rows["high"].astype(np.uint64) << np.uint64(32))


def _least(order: np.ndarray, heads: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return np.minimum.reduceat(ids[order], heads) if len(heads) else ids[:0]


def _once(ids: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((units, ids))
    ids, units = ids[order], units[order]
    heads = _heads(ids, units)
    return ids[heads], units[heads]


def regions(shape: Shape, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Step 1 on the side of the texts: the regions of a batch, one row for equal ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in K.parts(whole, "text", TASK_BYTES)):
            symbols, bounds, _, _ = _symbols(batch["text"], shape)
            found = K.anchors(symbols, bounds, shape.window, shape.gram)
            if not len(found.text):
                continue
            ids = batch["doc_id"].to_numpy()[found.text]
            units = _units(found)
            order = np.argsort(units)
            heads = _heads(units[order])
            least = _least(order, heads, ids)
            later = ids[order] > np.repeat(least, _sizes(heads, len(units)))
            done = _once(ids[order][later], units[order][later])
            one = order[heads]
            # an anchor with its left and with its right context: windows that two regions share, share one of these
            sides = [np.flatnonzero(side[one] != 0) for side in (found.left, found.right)]
            region = np.concatenate(sides)
            context = np.concatenate([side[one][rows] for side, rows in zip((found.left, found.right), sides)])
            keys = K.mix(found.key[one][region] * _ODD + context)
            settles = np.concatenate([np.ones(len(sides[0]), bool), found.left[one][sides[1]] == 0])
            shared = _often(keys)
            rows = np.zeros(len(keys), _ROW)
            rows["key"] = (keys & np.uint64(0xFFFFFFFE)) | settles.astype(np.uint64)
            rows["low"], rows["high"] = _halves(units[one][region])
            border = np.unique(region[shared])
            own = (least[border], units[one][border])
            sent = np.flatnonzero(~shared)
            out = list(_packed(_REGIONS, _bucket(keys, buckets)[sent], least[region][sent], rows[sent]))
            # a key with several regions in one task: the others learn of it by one row
            several, first = np.unique(keys[shared], return_index=True)
            named = np.zeros(len(several), _KEY)
            named["key"] = several & np.uint64(0xFFFFFFFE)
            out += _packed(_SHARED, _bucket(several, buckets), least[region][shared][first], named)
            out += _packed(_DONE, _spread(done[0], buckets), done[0], _as_units(done[1]))
            # border regions meet by their content, so their anchor gathers nothing and one document asks for each
            out += _packed(_BORDER, _spread(own[1], buckets), own[0], _as_units(own[1]))
            for i in range(0, len(out), 5000):
                yield _batch(out[i : i + 5000], _PACKED)

    return run


def compare_regions(table: pa.Table) -> pa.Table:
    """Step 1 on the side of the anchors: later documents of a region, and regions that may share windows."""
    ids, rows = _unpacked(table, _DONE, _UNIT)
    out = [_found(ids, _DONE, _from_units(rows))]
    ids, rows = _unpacked(table, _BORDER, _UNIT)
    ids, units, first = _by_unit(ids, _from_units(rows))
    out.append(_found(ids[first], _BORDER, units[first]))
    later = ids > np.repeat(ids[first], _sizes(first, len(ids)))
    out.append(_found(ids[later], _DONE, units[later]))
    ids, rows = _unpacked(table, _REGIONS, _ROW)
    units, key = _from_units(rows), rows["key"] >> 1
    order = np.lexsort((ids, units, key))
    ids, units, key, settles = ids[order], units[order], key[order], (rows["key"][order] & 1) == 1
    heads = _heads(key, units)
    later = settles & (ids > np.repeat(ids[heads], _sizes(heads, len(ids))))
    out.append(_found(ids[later], _DONE, units[later]))
    named = _unpacked(table, _SHARED, _KEY)[1]["key"] >> 1
    border = _often(key[heads]) | np.isin(key[heads], named)
    out.append(_found(ids[heads][border], _BORDER, units[heads][border]))
    return pa.Table.from_batches(out)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column of lists, and the row each belongs to. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.repeat(np.arange(len(column)), sizes)


def _among(rows: np.ndarray, values: np.ndarray, of_row: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which (row, value) pairs are among the wanted ones."""
    if not len(wanted):
        return np.zeros(len(rows), bool)
    mine, theirs = (K.mix(v ^ (r.astype(np.uint64) * _ODD)) for r, v in ((rows, values), (of_row, wanted)))
    maybe = np.zeros(1 << 22, bool)  # most pairs are told apart by 22 bits
    maybe[(theirs >> np.uint64(42)).astype(np.int64)] = True
    out = maybe[(mine >> np.uint64(42)).astype(np.int64)]
    rows = np.flatnonzero(out)
    theirs.sort()
    at = np.minimum(np.searchsorted(theirs, mine[rows]), len(theirs) - 1)
    out[rows] = theirs[at] == mine[rows]
    return out


def _border_windows(batch: pa.RecordBatch, symbols: np.ndarray, found: K.Anchors, units: np.ndarray, shape: Shape):
    """Windows of the regions that step 2 asks for: (row, start, hash)."""
    wanted, of_row = _lists(batch["border"])
    asked = _among(found.text, units, of_row, wanted)
    first, last = found.first[asked], found.last[asked]
    starts, hashes = K.windows(symbols, first, last, shape.window)
    return np.repeat(found.text[asked], last - first + 1), starts, hashes


def borders(shape: Shape, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Step 2 on the side of the texts: windows of border regions, one row for equal ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in K.parts(whole, "text", TASK_BYTES)):
            batch = batch.filter(pc.greater(pc.list_value_length(batch["border"]), 0))
            symbols, bounds, _, _ = _symbols(batch["text"], shape)
            found = K.anchors(symbols, bounds, shape.window, shape.gram)
            rows, _, hashes = _border_windows(batch, symbols, found, _units(found), shape)
            if not len(rows):
                continue
            ids = batch["doc_id"].to_numpy()[rows]
            order = np.argsort(hashes)
            heads = _heads(hashes[order])
            least = _least(order, heads, ids)
            later = ids[order] > np.repeat(least, _sizes(heads, len(ids)))
            docs, done = _once(ids[order][later], hashes[order][later])
            one = hashes[order[heads]]
            out = list(_packed(_REGIONS, _bucket(one, buckets), least, _as_units(one & _U48)))
            out += _packed(_DONE, _spread(docs, buckets), docs, _as_units(done & _U48))
            for i in range(0, len(out), 5000):
                yield _batch(out[i : i + 5000], _PACKED)

    return run


def compare_windows(table: pa.Table) -> pa.Table:
    """Step 2 on the side of the windows: the documents in which one starts that a smaller document holds."""
    ids, rows = _unpacked(table, _DONE, _UNIT)
    out = [_found(ids, _DONE, _from_units(rows))]
    ids, rows = _unpacked(table, _REGIONS, _UNIT)
    ids, hashes, first = _by_unit(ids, _from_units(rows))
    later = ids > np.repeat(ids[first], _sizes(first, len(ids)))
    out.append(_found(ids[later], _DONE, hashes[later]))
    return pa.Table.from_batches(out)


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_removed", pa.int64()),
        ("starts", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())),
        ("kept", pa.binary()),
    ]
)


def _kept(batch: pa.RecordBatch, shape: Shape) -> pa.RecordBatch:
    symbols, bounds, data, words = _symbols(batch["text"], shape)
    found = K.anchors(symbols, bounds, shape.window, shape.gram)
    units = _units(found)
    wanted, of_row = _lists(batch["done"])
    done = _among(found.text, units, of_row, wanted)
    rows, starts, hashes = _border_windows(batch, symbols, found, units, shape)
    wanted, of_row = _lists(batch["hits"])
    hit = starts[_among(rows, hashes & _U48, of_row, wanted)]
    gone = K.covered(len(symbols), found.first[done], found.last[done] - found.first[done] + shape.window)
    gone |= K.covered(len(symbols), hit, shape.window)
    edge = np.zeros(len(symbols) + 1, bool)
    edge[bounds] = True
    before, after = np.r_[False, gone[:-1]], np.r_[gone[1:], False]
    begin = np.flatnonzero(gone & (~before | edge[:-1]))
    end = np.flatnonzero(gone & (~after | edge[1:])) + 1
    of = np.searchsorted(begin, bounds)
    base = np.repeat(bounds[:-1], np.diff(of))
    cut = pa.array(of, pa.int32())
    total = np.r_[0, np.cumsum(gone)]
    if words is None:
        kept, lengths = data[~gone], np.r_[0, np.cumsum(~gone)][bounds]
    else:
        kept, lengths = _joined(data, words, ~gone)
    return pa.RecordBatch.from_arrays(
        [
            batch["doc_id"],
            pa.array(np.diff(bounds)),
            pa.array(np.diff(total[bounds])),
            pa.ListArray.from_arrays(cut, pa.array(begin - base)),
            pa.ListArray.from_arrays(cut, pa.array(end - base)),
            pa.Array.from_buffers(
                pa.binary(), len(bounds) - 1, [None, pa.py_buffer(lengths.astype(np.int32)), pa.py_buffer(kept)]
            ),
        ],
        schema=_OUT,
    )


def _joined(data: np.ndarray, words: K.Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words of each text with one space between them, and where each text's bytes begin."""
    rows = np.flatnonzero(keep)
    start, end = words.start[rows], words.end[rows]
    of = np.searchsorted(rows, words.bounds)  # kept words before each text
    last = np.zeros(len(rows) + 1, bool)
    last[of[1:]] = True
    space = (~last[1:]).astype(np.int64)  # a space after each word but the last of its text
    room = np.r_[0, np.cumsum(end - start + space)]
    kept = np.full(room[-1], 0x20, np.uint8)
    kept[K.ranges(room[:-1], room[1:] - space)] = data[K.ranges(start, end)]
    return kept, room[of]


def cut_out(shape: Shape) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Last step: the spans to remove from each text, and the rest of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in K.parts(whole, "text"):
                yield _kept(batch, shape)

    return run


def without_repeats(docs: DataFrame, shape: Shape) -> DataFrame:
    """doc_id, n_symbols, n_removed, the removed spans (starts, ends, in symbols) and the kept bytes of every row.

    A symbol goes if a window that covers it also starts in a row with a smaller doc_id. Rows of one doc_id never
    remove from each other, and equal rows fare alike. A row without doc_id is kept whole and removes nothing; a null
    text is empty. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = size // (6 if shape.words else 1) * 2 // (shape.window - shape.gram + 2)
    buckets = max(2 * tables.shuffles(spark), math.ceil(rows / GROUP_ROWS))
    step1 = tables.written(
        known.mapInArrow(regions(shape, buckets), _PACKED)
        .groupBy("bucket")
        .applyInArrow(compare_regions, _FOUND),
        "regions",
    )
    lists = step1.groupBy("doc_id").agg(
        F.collect_list(F.when(F.col("kind") == _DONE, F.col("unit"))).alias("done"),
        F.collect_list(F.when(F.col("kind") == _BORDER, F.col("unit"))).alias("border"),
    )
    # Both uses below read one shuffle of the texts: no condition tells them apart.
    marked = docs.join(lists, "doc_id", "left")
    hits = (
        marked.mapInArrow(borders(shape, buckets), _PACKED)
        .groupBy("bucket")
        .applyInArrow(compare_windows, _FOUND)
        .groupBy("doc_id")
        .agg(F.collect_set("unit").alias("hits"))
    )
    return (
        marked.join(hits, "doc_id", "left")
        .select("doc_id", "text", "done", "border", "hits")
        .mapInArrow(
            cut_out(shape),
            "doc_id long, n_symbols long, n_removed long, starts array<long>, ends array<long>, kept binary",
        )
    )
