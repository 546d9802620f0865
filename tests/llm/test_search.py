"""Ranked search, SentencePiece ids and whitening against plain versions."""

from __future__ import annotations

import json
import math
import re
import time
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from starmart.llm import lexical, pieces, whitening

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def best_documents(docs, items, most=10):
    """Scores of all documents, as the definition has them."""
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counts = [(doc_id, c, sum(c.values())) for doc_id, c in counts if c]
    count, total = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for doc_id, c, n in counts:
            m = 100 - 75 + (75 * n * count) // total
            score = 0
            for t in terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        scored.sort(key=lambda x: x[:3])
        out += [(item, i + 1, doc_id, -score) for i, (score, _, _, doc_id) in enumerate(scored[:most])]
    return sorted(out, key=str)


@pytest.mark.parametrize("block,passes,piece", [(16_384, 4_000_000, 1 << 20), (40, 2_000, 64), (1, 10**9, 1)])
def test_search(spark, frame, corpus, empty, block, passes, piece, monkeypatch):
    monkeypatch.setattr(lexical, "PASS_CHARS", passes)
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical, "PIECE", piece)
    extra = [(None, corpus[0][1]), (1000, "one TWO two"), (1000, corpus[3][1]), (77, "Éa éa ÉA x9 9")]
    items = [(i, corpus[i][1][:300]) for i in range(8)] + [(50, "One two two"), (50, "One two two"), (50, "na"), (51, None), (52, ""), (53, "nowhere"), (None, "éa 9"), (54, "É" * 120 + " a b")]
    items += [(60, corpus[0][1] + corpus[1][1] + corpus[2][1] + corpus[9][1])]  # well over 64 terms
    docs = frame.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string")).withColumn("score", F.lit("x")).withColumn("item", F.lit(1))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(0))
    got = lexical.search(docs, asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = best_documents([(d, t) for d, t, *_ in corpus] + extra, items)
    # rows that share id and score are told apart by nothing
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert lexical.search(empty, asked).count() == 0 and lexical.search(docs, asked.limit(0)).count() == 0


def test_masks_are_left_out_only_when_safe():
    """Random blocks: the best by masks are the best of all, ties included."""
    rng = np.random.default_rng(3)
    for docs, vocabulary, asked in ((300, 12, 9), (200, 400, 150), (5, 3, 3)):
        held = [np.flatnonzero(rng.random(vocabulary) < rng.choice([0.1, 0.6])) for _ in range(docs)]
        ends = np.r_[0, np.cumsum([len(h) for h in held])]
        block = lexical.Block(rng.integers(1, 40, docs), ends, np.concatenate(held), rng.integers(1, 4, ends[-1]), docs, 20 * docs)
        weights = np.zeros(vocabulary, np.int64)
        own = rng.choice(vocabulary, asked, replace=False)
        weights[own] = rng.integers(0, 3, asked)
        order = rng.permutation(docs)
        scores = block.scores(np.arange(docs), weights)
        best = sorted(np.flatnonzero(scores > 0), key=lambda i: (-scores[i], order[i]))[:10]
        found, values = block.best(weights, own, order, 10)
        assert list(found) == best and list(values) == list(scores[best])


@pytest.fixture(scope="module")
def model():
    pytest.importorskip("public_tokenizers")
    return pieces.read_model()


@pytest.mark.parametrize("pack", [16 << 20, 3000])
def test_pieces(spark, frame, corpus, empty, model, pack, monkeypatch):
    monkeypatch.setattr(pieces, "PACK", pack)
    cut = pieces.processor(model)
    odd = ["  a  b ", "a▁b▁▁", "▁", " ", "\x00x y\x00", "ﬁ ½\xa0x　y\tz\r\n\n q", "<s> </s><unk> <0x41>", "😀 👩‍👩‍👧 ​", "﻿a", "é" * 999, " " * 500 + "x", "1234567 12 3"]
    extra = [(5000 + i, t) for i, t in enumerate(odd)] + [(None, "no id"), (None, None), (4, "twice"), (4, "twice")]
    docs = frame.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string")).withColumn("ids", F.lit("x")).withColumn("pack", F.lit("x"))
    texts = [(d, t or "") for d, t, *_ in corpus] + [(d, t or "") for d, t in extra]
    rows = pieces.decoded(pieces.encoded(docs, model), model).collect()
    want = [(d, cut.encode(t, add_eos=True)) for d, t in texts]
    assert sorted(((r.doc_id, r.ids, r.text) for r in rows), key=str) == sorted(((d, i, cut.decode(i)) for d, i in want), key=str)
    digests = pieces.digest(pieces.decoded(pieces.encoded(docs.limit(3), model), model))
    assert digests.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and digests.count() == 3
    assert pieces.encoded(empty, model).count() == 0


def test_words_are_cut_before_marks(model):
    cut = pieces.processor(model)
    for text in ("", "a", " a", "  a b  c ", "▁a▁ ▁b", "\n a\n"):
        words = pieces._words(text)
        assert "".join(" " + w for w in words) == (" " + text.replace("▁", " ") if text else "")
        assert [i for own in pieces._ids(cut, words) for i in own] == cut.encode(text)


def test_ids_are_decoded_without_a_python_number_each(model):
    cut = pieces.processor(model)
    texts = ["", "a b", " é  😀 ▁", "\x00 <unk> 漢字 x", "one two three " * 20_000]
    lists = [cut.encode(t, add_eos=True) for t in texts] + [[], [0, 1, 2, 3, 200, 255, 5]]
    column = pa.array([[7], *lists, None], pa.list_(pa.int32())).slice(1)
    assert pieces._texts(cut, column) == [*(cut.decode(ids) for ids in lists), ""]
    for wrong in ([1, None], [cut.get_piece_size()], [-1]):
        with pytest.raises((IndexError, TypeError, pa.ArrowInvalid)):
            pieces._texts(cut, pa.array([wrong], pa.list_(pa.int32())))
    long, own = column.slice(4, 1), lists[4]

    def least(work):
        taken = []
        for _ in range(5):
            before = time.process_time()
            work()
            taken.append(time.process_time() - before)
        return min(taken)

    assert least(lambda: pieces._texts(cut, long)) < 2 * least(lambda: cut.decode(own))


def test_many_rows_are_decoded(spark, model):
    count = 2 * pieces.ROWS + 7
    ids = F.array((F.col("id") % 200 + 300).cast("int"), F.lit(5000), F.lit(2))
    rows = spark.range(0, count, 1, 1).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 9 > 0, ids).alias("ids"))
    cut = pieces.processor(model)
    got = {r.doc_id: (r.ids, r.text) for r in pieces.decoded(rows, model).collect()}
    want = {i: [i % 200 + 300, 5000, 2] if i % 9 else None for i in range(count)}
    assert got == {i: (own, cut.decode(own or [])) for i, own in want.items()}


def test_words_of_later_lists(model):
    cut = pieces.processor(model)
    lists = [["one", "", "漢字😀"], ["one", "of", "Donaudampfschiff"], ["Donaudampfschiff"], ["of", " x", "two", "one"]]
    sent = [zstandard.compress(json.dumps(own).encode()) for own in lists]
    batches = [
        pa.RecordBatch.from_pydict({"part": [3] * len(own), "pack": [f"{own[0]}"] * len(own), "words": [sent[i] for i in own]})
        for own in ([0, 1], [2, 3])
    ]
    out = pa.Table.from_batches(pieces._segmented(SimpleNamespace(value=model))(batches))
    assert out["pack"].to_pylist() == ["0", "0", "2", "2"] and out["part"].to_pylist() == [3] * 4
    for words, data in zip(lists, out["ids"].to_pylist()):
        raw, want = zstandard.decompress(data), pieces._ids(cut, words)
        assert np.frombuffer(raw, np.uint32, len(words)).tolist() == [len(own) for own in want]
        assert np.frombuffer(raw, np.uint16, offset=4 * len(words)).tolist() == [i for own in want for i in own]


def test_other_models_are_refused(model, monkeypatch):
    class Crossing:
        def __init__(self, **_):
            pass

        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "of▁the"

    import sentencepiece

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Crossing)
    with pytest.raises(ValueError):
        pieces.processor.__wrapped__(model)


def plainly_whitened(rows, most=16):
    ok = [(i, [math.floor(64 * float(c)) + 1000000 for c in v]) for i, v in rows]
    fit = np.unique(np.array([v for _, v in ok]), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    y = fit - sums / n
    covariance = y.T @ y / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    x = np.array([v for _, v in ok])
    return n, ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ axes / np.sqrt(values), values / np.trace(covariance)


def test_whitening(spark):
    rng = np.random.default_rng(1)
    spread = np.linspace(0.2, 3, 24)
    good = [(i, (rng.standard_normal(24) * spread).tolist()) for i in range(300)]
    good += [(1000 + i, good[7][1]) for i in range(150)] + [(3, good[9][1])]
    bad = [(2000, None), (2001, []), (2002, [None] + [0.0] * 23), (2003, [float("nan")] * 24), (2004, [float("inf")] + [0.0] * 23), (2005, [1.0] * 5), (2006, [1e300] + [0.0] * 23)]
    rows = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").withColumn("x", F.lit("x")).withColumn("n", F.lit(1)).repartition(5)
    got = whitening.whitened(rows)
    assert [c for c, _ in got.dtypes] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    n, deviation, whitened, explained = plainly_whitened(good)
    by_id = {}
    for r in got.collect():
        by_id.setdefault((r.vec_id, r.component), []).append(r)
    assert {k for k, _ in by_id} == {i for i, _ in good} and {c for _, c in by_id} == set(range(1, 17))
    signs = np.array([np.sign(by_id[0, c + 1][0].whitened * whitened[0, c]) for c in range(16)])
    copies = Counter(i for i, _ in good)
    for at, (i, _) in enumerate(good):
        for c in range(16):
            own = by_id[i, c + 1]
            assert len(own) == copies[i]
            assert any(r.deviation == deviation[at] and r.whitened * signs[c] == pytest.approx(whitened[at, c], abs=1e-9) for r in own)
            assert all(r.n == n and r.explained == pytest.approx(explained[c], rel=1e-12) and r.identity_error < 1e-12 for r in own)


def test_whitening_of_little(spark):
    few = lambda rows: whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert few([]).count() == 0 and few([(1, None)]).count() == 0
    assert few([(1, [1.0, 2.0])] * 5).count() == 0  # one distinct vector: no direction
    line = few([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)]).collect()
    assert len(line) == 9 and {r.component for r in line} == {1} and line[0].explained == pytest.approx(1.0)
    far = few([(1, [2.0**50, 0.0]), (2, [-(2.0**50), 1.0]), (None, [0.0, 5.0])]).collect()
    assert {r.vec_id for r in far} == {1, 2, None} and {r.deviation for r in far if r.vec_id == 1} == {None}


@pytest.mark.parametrize("size,wanted", [(1, 16), (7, 3), (64, 16), (300, 16)])
def test_jacobi_davidson(size, wanted):
    rng = np.random.default_rng(size)
    axes = np.linalg.qr(rng.standard_normal((size, size)))[0]
    values = np.sort(np.r_[rng.random(size) ** 3])[::-1] * 50
    values[1:2] = values[0]  # a double one
    matrix = (axes * values) @ axes.T
    passes = []
    found, vectors = whitening.jacobi_davidson(lambda block: passes.append(block.shape[1]) or matrix @ block, size, wanted)
    assert len(found) == min(size, wanted) and np.allclose(found, values[: len(found)], rtol=1e-13, atol=1e-11)
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-11 and np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-13)
    assert len(passes) < 400


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(0)
    matrix = rng.standard_normal((30, 30))
    matrix = matrix + matrix.T
    right = rng.standard_normal((30, 4))
    assert np.allclose(whitening.minres(lambda b: matrix @ b, right, 200, 1e-12), np.linalg.solve(matrix, right), atol=1e-6)
