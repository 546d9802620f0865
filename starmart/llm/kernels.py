"""Numpy kernels that tasks run over blocks of texts: words, rolling hashes, sampled anchors.

Texts arrive as Arrow columns and stay one flat array of bytes; nothing is looked at text by text. Hashes are
polynomials modulo 2^64, taken from running sums, so the hash of any span costs two look-ups.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes or words handled at a time: bounds the memory of a task whatever the size of its input.
BLOCK = 1 << 18
WHITESPACE = bytes([0x20, *range(0x09, 0x0E)])
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Held(dict):
    """Numbers that each process works out for itself: they don't travel with the code."""

    def __reduce__(self):
        return _Held, ()


_powers: dict[int, np.ndarray] = _Held()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole number (in place)."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    h ^= h >> np.uint64(32)
    return h


def powers(base: int, n: int) -> np.ndarray:
    held = _powers.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, BLOCK + 4096), base, np.uint64)
        held[0] = 1
        _powers[base] = held = np.multiply.accumulate(held)
    return held[:n]


class Spans:
    """Hashes of spans of one sequence of symbols."""

    def __init__(self, symbols: np.ndarray):
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * powers(_BASE, len(symbols)), out=self.sums[1:])
        self.back = powers(_INVERSE, len(symbols) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])

    def all(self, length: int) -> np.ndarray:
        """Of the spans of this length that start at 0, 1, 2 ..."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[length:] - self.sums[:n]) * self.back[:n])


def symbol_table(separators: Iterable[int] = (), lower: bool = False) -> np.ndarray:
    """A random number per byte; 0 for separators. With `lower`, A-Z count as a-z."""
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    if lower:
        table[65:91] = table[97:123]
    table[list(separators)] = 0
    return table


BYTES = symbol_table()


def part(symbols: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Symbols as numbers to hash. Bytes are widened only here, piece by piece."""
    return BYTES[symbols[lo:hi]] if symbols.dtype == np.uint8 else symbols[lo:hi]


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts, and where each text begins (one more entry for the end). Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    kind = texts.type
    wide = pa.types.is_large_string(kind) or pa.types.is_large_binary(kind)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = bounds.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def parts(batch: pa.RecordBatch, column: str, size: int = 2 * BLOCK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about so many bytes of text each, one text at least."""
    sizes = np.cumsum(np.diff(flat(batch[column])[1]))
    lo = 0
    while lo < len(sizes):
        before = int(sizes[lo - 1]) if lo else 0
        hi = min(max(lo + 1, int(np.searchsorted(sizes, before + size))), lo + (1 << 16))
        yield batch.slice(lo, hi - lo)
        lo = hi


@dataclass
class Words:
    """Words of a block of texts: their hashes, and where they lie in the bytes and in the texts."""

    hashes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray  # of each text among the words


def words(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> Words:
    """Maximal runs of bytes that are no separators. Runs end where texts end."""
    inside = table != 0
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    lo, n = 0, len(data)
    while lo < n:
        hi = min(n, lo + BLOCK)
        if hi < n:  # cut before a word, or where a text ends; a longer word is taken whole
            stops = np.flatnonzero(~inside[data[lo:hi]])
            text = np.searchsorted(bounds, hi, "right") - 1
            cut = max(lo + int(stops[-1]) + 1 if len(stops) else lo, int(bounds[text]))
            while cut <= lo:
                ahead = np.flatnonzero(~inside[data[hi : hi + BLOCK]])
                cut = hi + int(ahead[0]) + 1 if len(ahead) else min(n, hi + BLOCK)
                following = int(bounds[min(np.searchsorted(bounds, lo, "right"), len(bounds) - 1)])
                cut = min(cut, following) if following > lo else cut
                if not len(ahead) and cut == hi + BLOCK and cut < n:
                    hi, cut = cut, lo
            hi = cut
        part = data[lo:hi]
        word = inside[part]
        breaks = np.zeros(hi - lo, bool)
        breaks[bounds[(bounds >= lo) & (bounds < hi)] - lo] = True
        before = np.empty(hi - lo, bool)
        before[0] = False
        before[1:] = word[:-1]
        start = np.flatnonzero(word & (~before | breaks))
        after = np.empty(hi - lo, bool)
        after[-1] = False
        after[:-1] = word[1:] & ~breaks[1:]
        end = np.flatnonzero(word & ~after) + 1
        found.append((Spans(table[part]).of(start, end) + (end - start).astype(np.uint64), start + lo, end + lo))
        lo = hi
    hashes, start, end = (
        (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, t) for t in (np.uint64, np.int64, np.int64))
    )
    return Words(hashes, start, end, np.searchsorted(start, bounds))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values."""
    step = 1
    while step * 2 <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def pieces(bounds: np.ndarray, margin: int) -> Iterator[tuple[int, int, int, int]]:
    """Cuts of a block of sequences: (from, to, first, last) with the starts first..last-1 to be handled.

    Short sequences share a piece; a long one is cut, with `margin` symbols of its own around each cut.
    """
    i, count = 0, len(bounds) - 1
    while i < count:
        lo, hi = int(bounds[i]), int(bounds[i + 1])
        if hi - lo > BLOCK:
            for first in range(lo, hi, BLOCK):
                last = min(hi, first + BLOCK)
                yield max(lo, first - margin), min(hi, last + 2 * margin), first, last
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(bounds, lo + BLOCK, "right")) - 1)
        while bounds[j] - bounds[j - 1] > BLOCK:
            j -= 1
        yield lo, int(bounds[j]), lo, int(bounds[j])
        i = j


@dataclass
class Anchors:
    """Sampled positions of sequences. Each owns the windows first..last that choose it.

    `key` hashes the anchor, `region` all that its windows cover, `left` and `right` the context next to the anchor
    that any of these windows holds on one side at least (0 where the region ends before).
    """

    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    key: np.ndarray
    region: np.ndarray
    left: np.ndarray
    right: np.ndarray


def anchors(symbols: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> Anchors:
    """Winnowing: each window of symbols chooses its least gram, the first of equal ones.

    Which gram a window chooses depends on its content alone, so equal windows choose equal anchors.
    """
    reach = (window - gram + 1) // 2
    out: list[tuple[np.ndarray, ...]] = []
    mask = np.uint64((1 << 22) - 1)
    for lo, hi, begin, stop in pieces(bounds, window):
        n = hi - lo
        if n < window:
            continue
        spans = Spans(part(symbols, lo, hi))
        rank = spans.all(gram)
        rank &= ~mask
        rank |= np.arange(len(rank), dtype=np.uint64)
        least = sliding_min(rank, window - gram + 1)
        valid = np.zeros(n, bool)
        valid[begin - lo : stop - lo] = True
        valid[n - window + 1 :] = False
        ends = bounds[(bounds > lo) & (bounds <= hi)] - lo
        over = (ends[:, None] - np.arange(1, window)).ravel()
        valid[over[over >= 0]] = False
        # a text shorter than a window also blocks starts before it, which end beyond their own text anyway
        start = np.flatnonzero(valid)
        if not len(start):
            continue
        own = (least[start] & mask).astype(np.int64)
        head = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        first, last, at = start[head], start[np.r_[head[1:], len(start)] - 1], own[head]
        text = np.searchsorted(bounds, lo + first, "right") - 1
        left = np.where(at - reach >= first, spans.of(np.maximum(at - reach, 0), at) | np.uint64(1), np.uint64(0))
        beyond = at + gram + reach
        right = np.where(beyond <= last + window, spans.of(at + gram, np.minimum(beyond, n)) | np.uint64(1), np.uint64(0))
        region = spans.of(first, last + window) + (last - first).astype(np.uint64)
        out.append((text, lo + first, lo + last, spans.of(at, at + gram), region, left, right))
    if not out:
        whole, none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return Anchors(whole, whole, whole, none, none, none, none)
    return Anchors(*(np.concatenate(x) for x in zip(*out)))


def windows(symbols: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts first..last of every run in one array, and the hashes of the windows that start there.

    The runs come in the order of the sequence. They are hashed block by block."""
    starts = ranges(first, last + 1)
    hashes = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        lo = int(starts[at])
        to = int(np.searchsorted(starts, lo + BLOCK))
        own = starts[at:to] - lo
        hashes[at:to] = Spans(part(symbols, lo, int(starts[to - 1]) + length)).of(own, own + length)
        at = to
    return starts, hashes


def ranges(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers first..end-1 of every pair, one pair after the other."""
    sizes = end - first
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    steps = np.ones(total, np.int64)
    heads = np.cumsum(sizes) - sizes
    keep = sizes > 0
    first, end, heads = first[keep], end[keep], heads[keep]
    steps[heads[0]] = first[0]
    steps[heads[1:]] = first[1:] - end[:-1] + 1
    return np.cumsum(steps)


def covered(n: int, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """Which of n symbols lie in one of the spans."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0


def distinct(codes: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of a 48-bit code and a number below 2^16, with their counts. Whole numbers sort fastest."""
    if len(of) and of.max() >= 1 << 16:
        raise ValueError("too many rows in one slice")
    both, counts = np.unique((codes << np.uint64(16)) | of.astype(np.uint64), return_counts=True)
    return both >> np.uint64(16), (both & np.uint64(0xFFFF)).astype(np.int64), counts
