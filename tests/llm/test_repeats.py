"""Passages that documents share: against a brute-force version, symbol by symbol."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from starmart.llm import prefix_free, repeats, suffix_tree


def brute(rows, window, words):
    texts = {d: ((t or "").encode().split() if words else list((t or "").encode())) for d, t, *_ in rows}
    first = {}
    for doc in sorted(texts):
        for i in range(len(texts[doc]) - window + 1):
            first.setdefault(tuple(texts[doc][i : i + window]), doc)
    out = {}
    for doc, symbols in texts.items():
        gone = [False] * len(symbols)
        for i in range(len(symbols) - window + 1):
            if first[tuple(symbols[i : i + window])] < doc:
                gone[i : i + window] = [True] * window
        left = [s for s, g in zip(symbols, gone) if not g]
        kept = b" ".join(left) if words else bytes(left)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(symbols), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("words", [True, False])
@pytest.mark.parametrize("task_bytes", [8 << 20, 3000])
def test_against_brute_force(frame, corpus, words, task_bytes, monkeypatch):
    monkeypatch.setattr(repeats, "TASK_BYTES", task_bytes)
    rows = [r for r in corpus if words or r[0] not in (6, 7)] + ([] if words else [(6, "na " * 500), (7, "x" * 3000)])
    docs = frame if words else frame.withColumn(
        "text", F.when(F.col("doc_id") == 6, F.repeat(F.lit("na "), F.lit(500))).when(F.col("doc_id") == 7, F.repeat(F.lit("x"), F.lit(3000))).otherwise(F.col("text"))
    )
    if words:
        got = suffix_tree.digest(suffix_tree.without_repeated_passages(docs)).collect()
        want = {d: (n, gone, sha) for d, (n, gone, _, sha) in brute(rows, 13, True).items()}
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want
    else:
        got = prefix_free.digest(prefix_free.without_repeated_bytes(docs)).collect()
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute(rows, 50, False)
    assert any(r.n_removed for r in got)


def test_spans_name_what_is_removed(frame, corpus):
    texts = {d: (t or "").split() for d, t, *_ in corpus}
    for r in suffix_tree.without_repeated_passages(frame.where("doc_id >= 1000")).collect():
        gone = [i for a, b in zip(r.starts, r.ends) for i in range(a, b)]
        assert len(gone) == r.n_removed
        assert " ".join(w for i, w in enumerate(texts[r.doc_id]) if i not in set(gone)).encode() == bytes(r.kept)


def test_ids_ties_and_empty_tables(spark, empty):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(5, text), (5, text), (5, "other " + text), (None, text), (9, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in suffix_tree.without_repeated_passages(docs).collect())
    assert got == [(0, 0), (5, 0), (5, 0), (5, 0), (9, 20)]
    for found in (suffix_tree.without_repeated_passages(empty), prefix_free.without_repeated_bytes(empty)):
        assert found.count() == 0


def test_texts_are_shuffled_once(frame, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = suffix_tree.without_repeated_passages(frame)
        found.write.format("noop").mode("overwrite").save()
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "ReusedExchange" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
