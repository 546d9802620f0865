"""Near copies against all pairs, and components against a plain search."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest

from starmart.llm import minhash
from starmart.llm.components import components


def sets(rows):
    out = {}
    for doc, text, *_ in rows:
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
        out[doc] = grams
    return out


def reach(nodes, links):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


def all_pairs(rows):
    grams = sets(rows)
    links = [(a, b) for a, b in combinations(grams, 2) if grams[a] and 100 * len(grams[a] & grams[b]) >= 85 * len(grams[a] | grams[b])]
    return grams, reach(grams, links)


def test_against_all_pairs(frame, corpus):
    grams, least = all_pairs(corpus)
    got = {r.doc_id: r for r in minhash.near_copies(frame).collect()}
    assert {d: r.n_shingles for d, r in got.items()} == {d: len(g) for d, g in grams.items()}
    assert {d: r.component_id for d, r in got.items()} == least
    assert all(r.kept == (d == r.component_id) for d, r in got.items())
    assert len(set(least.values())) < len(least) - 10


def test_a_family_linked_through_its_origin(spark):
    """Copies overlap with the origin by 86 %, with each other by less than 85 %."""
    rnd = random.Random(3)
    origin = [f"w{rnd.randrange(10**6)}" for _ in range(700)]
    rows = [(500, " ".join(origin))]
    for i in range(150):
        words = list(origin)
        for at in rnd.sample(range(4, 690, 7), 10):
            words[at] = f"new{i}_{at}"
        rows.append((i + 1, " ".join(words)))
    grams, least = all_pairs(rows)
    assert set(least.values()) == {1}
    got = minhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: r.component_id for r in got} == least


@pytest.mark.parametrize("fillings", [5, 10])
def test_a_family_from_a_template(spark, fillings):
    """One body with six slots; documents are linked where they differ in up to two slots, seldom with one middle."""
    rnd = random.Random(fillings)
    words = lambda n: [f"w{rnd.randrange(10**9)}" for _ in range(n)]
    body, slots = [words(46) for _ in range(7)], [[words(6) for _ in range(fillings)] for _ in range(6)]
    rows = []
    for i in range(250):
        text = list(body[0])
        for part, slot in zip(body[1:], slots):
            text += rnd.choice(slot) + part
        rows.append((i + 1, " ".join(text)))
    grams, least = all_pairs(rows)
    assert len(set(least.values())) < 240
    got = minhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: r.component_id for r in got} == least


def test_ids_ties_and_empty_tables(spark, empty):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (9, "A B c d e f"), (None, "a b c d e f"), (10, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in minhash.near_copies(docs).collect())
    assert got == [(0, 0, True), (5, 5, True), (5, 5, True), (9, 5, False), (10, 10, True)]
    assert minhash.near_copies(empty).count() == 0
    assert sorted(r.doc_id or 0 for r in minhash.without_near_copies(docs).collect()) == [0, 5, 10]


def test_an_id_with_different_texts(spark):
    """It is linked with what either text is linked with, whichever rows come first, and joins both groups."""
    rnd = random.Random(8)
    base = [[f"w{rnd.randrange(10**6)}" for _ in range(200)] for _ in range(3)]
    near = [[*words[:-1], "changed"] for words in base]
    rows = [(1, base[0]), (1, base[1]), (1, base[2]), (20, near[0]), (21, near[1]), (22, near[2]), (22, ["else"] * 9), (23, ["else"] * 9)]
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string").repartition(3)
    assert {(r.doc_id, r.component_id) for r in minhash.near_copies(docs).collect()} == {(d, 1) for d, _ in rows}


def test_bins_are_borrowed_alike():
    text, hashes = np.zeros(3, np.int64), np.array([1 << 40, 1 << 62, 3 << 61], np.uint64)
    one = minhash.bins(text, hashes, 2)
    assert (one[0] != one[1]).all() and (one[1] == np.uint64(2**64 - 1)).all()
    assert (one[:1] == minhash.bins(text, hashes[::-1], 1)).all()


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rnd = random.Random(1)
    links = {
        "chain": [(i, i + 1) for i in range(40)],
        "star": [(99, i) for i in range(50)],
        "random": [(rnd.randrange(80), rnd.randrange(80)) for _ in range(50)],
        "none": [],
    }[shape]
    nodes = {n for link in links if link[0] != link[1] for n in link}
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: c for n, c in reach(nodes, [x for x in links if x[0] != x[1]]).items()}
